"""Whole volumes and captions: many cases in one text, contents lists, and the head of a case."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VERSUS = re.compile(r"^(?P<a>[A-Z][^\n]{2,80}?)\s+(?:v\.|vs\.?|versus)\s+(?P<b>[A-Z][^\n]{2,80}?)\s*[.,]?$", re.I)
_ENTRY = re.compile(r"^(?P<number>\d{1,4}[A-Z]?(?:-[A-Z])?)[.)]\s+(?P<heading>.+?)(?:[\s.]{4,}(?P<page>\d{1,4}))?\s*$")
_CASE_ENTRY = re.compile(r"^(?P<title>\S.+?\s(?:v\.|vs\.?|versus)\s.+?)[\s.]{3,}(?P<page>\d{1,4})\s*$", re.I)
_OMITTED = re.compile(r"\b(?:omitted|repealed|deleted)\b", re.I)


def contents_of(text: str | None) -> list[dict]:
    """The entries of a contents list: number, heading, page and whether the entry says that it was omitted."""
    out = []
    for line in (text or "").splitlines():
        m = _ENTRY.match(line.strip())
        if m:
            out.append({"number": m["number"], "heading": m["heading"].strip(" ."), "page": int(m["page"]) if m["page"] else None, "omitted": bool(_OMITTED.search(m["heading"]))})
    return out


def cases_listed_of(text: str | None) -> list[dict]:
    """The entries of a table of cases: title and page."""
    return [{"title": m["title"].strip(), "page": int(m["page"])} for m in map(_CASE_ENTRY.match, (x.strip() for x in (text or "").splitlines())) if m]


def split_volume_of(text: str | None, least: int = 40) -> list[dict]:
    """The cases of a volume: from each caption line to the next; of the same parties the longest text stands.

    A caption is a line of two parties with a blank line, or the start of the text, before it. A caption with less than
    ``least`` characters behind it is an entry of a list and no case.
    """
    lines = (text or "").splitlines()
    starts = [i for i, x in enumerate(lines) if _VERSUS.match(x.strip()) and (i == 0 or not lines[i - 1].strip())]
    best: dict[tuple[str, str], dict] = {}
    for k, i in enumerate(starts):
        m = _VERSUS.match(lines[i].strip())
        body = "\n".join(lines[i + 1 : starts[k + 1] if k + 1 < len(starts) else len(lines)]).strip()
        key = (re.sub(r"\W+", "", m["a"].lower()), re.sub(r"\W+", "", m["b"].lower()))
        if len(body) >= least and len(body) > len(best.get(key, {"body": ""})["body"]):
            best[key] = {"petitioner": m["a"].strip(), "respondent": m["b"].strip(), "line": i + 1, "body": body}
    return sorted(best.values(), key=lambda c: c["line"])


def check_contents_of(contents: str | None, body: str | None) -> list[dict]:
    """The contents as a checklist of the body: each entry found in order or not, and whether its section is thin.

    An entry is found if a line of the body, after the one found before, begins with its number.
    """
    lines = (body or "").splitlines()
    heads = [(i, m["number"]) for i, x in enumerate(lines) if (m := re.match(r"\s*(?P<number>\d{1,4}[A-Z]?(?:-[A-Z])?)[.)]\s", x))]
    out, at = [], 0
    for e in contents_of(contents):
        hit = next((k for k in range(at, len(heads)) if heads[k][1] == e["number"]), None)
        thin = None
        if hit is not None:
            end = heads[hit + 1][0] if hit + 1 < len(heads) else len(lines)
            thin = len("\n".join(lines[heads[hit][0] : end]).strip()) < 40
            at = hit + 1
        out.append({"number": e["number"], "found": hit is not None, "thin": thin, "omitted": e["omitted"]})
    return out


CASE = "petitioner string, respondent string, line int, body string"


def split_volumes(volumes: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, petitioner, respondent, line, body) of the cases of every volume; a volume without a caption has none."""
    kind = dict(volumes.dtypes)[id_col]

    def split(batches):
        for batch in batches:
            rows = [(i, c["petitioner"], c["respondent"], c["line"], c["body"]) for i, t in zip(batch[id_col], batch[text]) for c in split_volume_of(t)]
            yield pd.DataFrame(rows, columns=[id_col, "petitioner", "respondent", "line", "body"], dtype=object)

    return volumes.where(F.col(text).isNotNull()).select(id_col, text).mapInPandas(split, f"{id_col} {kind}, {CASE}")


def contents_entries(text: Column) -> Column:
    @F.pandas_udf("array<struct<number string, heading string, page int, omitted boolean>>")
    def entries(texts: pd.Series) -> pd.Series:
        return pd.Series([contents_of(t) for t in texts], dtype=object)

    return entries(text)


CAPTION_END = r"(?m)^\s*(?i:order|judgment|judgement|coram\b[^\n]*|present:[^\n]*)\s*$|[A-Z' .]{5,}, (?:J|JJ|C\.J)\.--"


def caption(text: Column) -> Column:
    """The head of a case: what stands before the first order, judgment, coram or judge's line; the whole text where there is none."""
    cut = F.regexp_instr(text, F.lit(CAPTION_END))
    return F.when(cut > 1, F.substr(text, F.lit(1), cut - 1)).otherwise(text)


def case_head(text: Column) -> Column:
    """Struct (title, docket, hearing) read from the lines of a case's head."""
    c = caption(text)
    return F.struct(
        F.nullif(F.regexp_extract(c, r"(?im)^(.{3,90}? (?:v\.|vs\.?|versus) .{2,90}?)\s*$", 1), F.lit("")).alias("title"),
        F.nullif(F.regexp_extract(c, r"(?m)^\s*([A-Z][A-Za-z. ]{0,12}No\. ?[0-9]+\S* of [0-9]{4})\s*$", 1), F.lit("")).alias("docket"),
        F.nullif(F.regexp_extract(c, r"(?i)date of hearing: ?([0-9A-Za-z ,.]+)", 1), F.lit("")).alias("hearing"),
    )


# Lines that PDF readers leave behind.
JUNK = r"[\u200b-\u200f\u202a-\u202e\u2060\ufeff\u00ad\x00-\x08\x0b\x0c\x0e-\x1f]"


def clean_text(text: Column) -> Column:
    """Control and zero-width characters out, blanks collapsed, lines stripped, at most one blank line in a row."""
    out = F.regexp_replace(text, JUNK, "")
    out = F.regexp_replace(F.translate(out, "\u00a0\t", "  "), r"\r\n?", "\n")
    out = F.regexp_replace(F.regexp_replace(out, r" {2,}", " "), r"(?m)^ +| +$", "")
    return F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def best_body(listing: Column, pdf: Column, least: int = 200) -> Column:
    """The text of the file where it is long enough and longer than the listing's, else the listing's."""
    a, b = F.coalesce(F.length(F.trim(listing)), F.lit(0)), F.coalesce(F.length(F.trim(pdf)), F.lit(0))
    return F.when((b >= least) & (b > a), pdf).otherwise(F.coalesce(listing, pdf))
