"""Mentions with their place in the text: Arrow UDFs that give arrays of spans, to be exploded."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SEATS = r"SC|S\.C\.|Supreme Court|FSC|Federal Shariat Court|Lahore|Lah\.|Karachi|Kar\.|Peshawar|Pesh\.|Islamabad|Isl\.|Quetta|Que\."
# Reports that put the year first.
_YEAR_FIRST = ["SCMR", "CLC", "CLD", "MLD", "PCrLJ", "PLC", "PLJ", "PTCL", "PTD", "YLR", "GBLR"]


def _spaced(code: str) -> str:
    return r"\.?\s?".join(map(re.escape, code)) + r"\.?"


#: (family, pattern) in the order in which equal spans are preferred; a notes edition has its N right after the code.
CITATION_FAMILIES = [
    ("PLD", re.compile(rf"\b{_spaced('PLD')}\s*(?P<year>(?:19|20)\d\d)\s+(?P<court>{_SEATS})\s+(?P<page>\d+)\b", re.I)),
    *[(f"{c}N", re.compile(rf"\b(?P<year>(?:19|20)\d\d)\s+{_spaced(c)}N\.?\s+(?P<page>\d+)\b", re.I)) for c in ("CLC", "YLR", "PLC", "PCrLJ")],
    *[(c, re.compile(rf"\b(?P<year>(?:19|20)\d\d)\s+{_spaced(c)}\s+(?:Note\s+)?(?P<page>\d+)\b", re.I)) for c in _YEAR_FIRST],
    ("NEUTRAL", re.compile(r"\b(?P<year>(?:19|20)\d\d)\s+(?P<court>SHC (?:KHI|HYD|SUK|LRK|MPK)|LHC|IHC|PHC|SCP)\s+(?P<page>\d+)\b")),
]

SPAN = "array<struct<family string, year int, court string, page int, raw string, start int, end int>>"


def citation_spans_of(text: str | None, low: int = 1947, high: int = 2030) -> list[dict]:
    """Citations of a text by place, of the years that the reports cover. Of overlapping ones a notes edition beats its parent, then the longer wins, then the earlier family."""
    found = []
    for rank, (family, pattern) in enumerate(CITATION_FAMILIES):
        for m in pattern.finditer(text or ""):
            year = int(m["year"])
            if low <= year <= high:
                court = m.groupdict().get("court")
                found.append((m.start(), m.end(), rank, {"family": family, "year": year, "court": court.upper().replace(".", "") if court else "", "page": int(m["page"][:9]), "raw": m.group(0), "start": m.start(), "end": m.end()}))
    found.sort(key=lambda x: (not x[3]["family"].endswith("N"), -(x[1] - x[0]), x[2], x[0]))
    starts: list[int] = []  # of the spans that stand, which never overlap; their ends beside them
    ends: list[int] = []
    out = []
    for start, end, _, row in found:
        k = bisect_left(starts, start)
        if (k == 0 or ends[k - 1] <= start) and (k == len(starts) or starts[k] >= end):
            starts.insert(k, start)
            ends.insert(k, end)
            out.append(row)
    return sorted(out, key=lambda r: r["start"])


def citation_spans(text: Column) -> Column:
    """All citations of each text with their spans; [] for null and empty texts."""

    @F.pandas_udf(SPAN)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([citation_spans_of(t) for t in texts], dtype=object)

    return spans(text)


def passage(text: Column, start: Column, end: Column, width: int = 400) -> Column:
    """A window of ``width`` characters centred on a span (offsets from 0)."""
    half = F.floor((F.lit(width) - (end - start)) / 2).cast("int")
    return F.substr(text, F.greatest(start - half, F.lit(0)) + 1, F.lit(width))


def sentence(text: Column, start: Column, end: Column) -> Column:
    """The sentence around a span: from after the last '. ' before it to the first after it."""
    before = F.substr(text, F.lit(1), start)
    tail = F.substr(text, end + 1)
    lead = F.coalesce(F.regexp_extract(before, r"(?s)^(?:.*\. )?(.*)$", 1), F.lit(""))
    rest = F.regexp_extract(tail, r"(?s)^(.*?\.)(?: |$)", 1)
    return F.trim(F.concat(lead, F.substr(text, start + 1, end - start), F.when(rest == "", tail).otherwise(rest)))


_ACT = re.compile(r"\b((?:[A-Z][a-z]+ )(?:(?:[A-Z][a-z]+|and|of|for) ){0,6}(?:\([A-Z][a-z]+(?: [A-Z][a-z]+)*\) )?(?:Act|Ordinance|Order|Rules|Regulations|Code), (?:18|19|20)\d\d)")
_SECTION = re.compile(r"\b(section|article|rule)s? (\d+[A-Z]?(?:\(\w+\))*)", re.I)
_OF = re.compile(r"^ of (?:the )?$", re.I)
STATUTE_SPAN = "array<struct<kind string, number string, statute string, start int, bound_by string>>"


def statute_spans_of(text: str | None, reach: int = 200) -> list[dict]:
    """Section references of a text with the statute each belongs to: the one that follows 'of the', else the nearest one before within reach."""
    text = text or ""
    acts = [(m.start(), m.end(), m.group(1)) for m in _ACT.finditer(text)]
    starts, ends = [x[0] for x in acts], [x[1] for x in acts]
    out = []
    for m in _SECTION.finditer(text):
        k, p = bisect_left(starts, m.end()), bisect_right(ends, m.start()) - 1
        after = acts[k] if k < len(acts) and starts[k] - m.end() <= 12 and _OF.match(text[m.end() : starts[k]]) else None
        before = acts[p] if p >= 0 and m.start() - ends[p] <= reach else None
        bound = after or before
        out.append({"kind": m.group(1).lower(), "number": m.group(2), "statute": bound[2] if bound else None, "start": m.start(), "bound_by": "following" if after else "preceding" if before else "none"})
    return out


def statute_spans(text: Column) -> Column:
    @F.pandas_udf(STATUTE_SPAN)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([statute_spans_of(t) for t in texts], dtype=object)

    return spans(text)


_OPERATIONS = {"inserted": "insert", "substituted": "substitute", "omitted": "omit", "repealed": "repeal", "added": "insert", "deleted": "omit"}
_OPERATION = re.compile(r"\b(?:shall be|is hereby|are hereby|hereby|stands?|shall stand) (inserted|substituted|omitted|repealed|added|deleted)\b", re.I)
AMENDMENT = "array<struct<operation string, number string, statute string, start int>>"


def amendments_of(text: str | None, reach: int = 260) -> list[dict]:
    """(operation, section, statute) of the amending clauses: the nearest section reference within the clause of each operation."""
    text = text or ""
    refs = statute_spans_of(text)
    out = []
    for m in _OPERATION.finditer(text):
        left = max(text.rfind(".", 0, m.start()), text.rfind(";", 0, m.start()), text.rfind("\n", 0, m.start()), m.start() - reach)
        stops = [p for p in (text.find(ch, m.end()) for ch in ".;\n") if p >= 0]
        right = min([m.end() + reach, *stops])
        near = [r for r in refs if left < r["start"] < right]
        if near:
            r = min(near, key=lambda r: (abs(r["start"] - m.start()), r["start"]))
            out.append({"operation": _OPERATIONS[m.group(1).lower()], "number": r["number"], "statute": r["statute"], "start": m.start()})
    return out


def amendments(text: Column) -> Column:
    @F.pandas_udf(AMENDMENT)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([amendments_of(t) for t in texts], dtype=object)

    return spans(text)
