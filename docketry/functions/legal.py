"""Judges, benches, proceedings, treatments and mentions, as the corpus writes them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.text import collapse


def bench_type(size: Column) -> Column:
    """single, division, full or larger; null for no judges."""
    return F.when(size == 1, "single").when(size == 2, "division").when(size.between(3, 5), "full").when(size > 5, "larger")


# Titles before and after a judge's name.
_BEFORE = r"(?i)^((the|hon'?ble|honourable|mr\.?|mrs\.?|ms\.?|miss|dr\.?|justice|chief|acting|syed|\(r\)|\(retd\.?\))\s+)+"
_AFTER = r"(?i),?\s*(actg\.?\s*)?(jj?\.?|c\.?j\.?|acj|hcj)\s*$"


def judge_name(raw: Column) -> Column:
    """A judge's name without titles and punctuation, upper- or lower-case words capitalised."""
    s = F.regexp_replace(collapse(raw), _AFTER, "")
    s = F.regexp_replace(s, _BEFORE, "")
    s = F.regexp_replace(F.regexp_replace(s, r"[^A-Za-z0-9 .'-]", " "), r"\s+", " ")
    s = F.regexp_replace(s, r"^[ .-]+|[ .-]+$", "")
    words = F.transform(
        F.split(s, " "),
        lambda w: F.when((w == F.upper(w)) | (w == F.lower(w)), F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))).otherwise(w),
    )
    return F.array_join(words, " ")


# Kinds of proceeding in the order in which they are tried: (kind, phrases, abbreviations, letters after the
# number). 'criminal …' and 'revenue …' before a phrase ask for one of the words below at most so many characters before it.
# The letters of an abbreviation stand with or without points and blanks between them, unless it is given with points.
PROCEEDINGS = [
    ("habeas_corpus", ["habeas", "491"], [], ["h"]),
    ("bail", ["bail"], ["b.a."], ["b"]),
    ("leave_to_appeal", ["leave to appeal"], ["c p l a", "cr p l a", "crl p l a"], []),
    ("intra_court_appeal", ["intra court", "intra-court", "intracourt"], ["i c a"], []),
    ("criminal_reference", ["murder reference", "criminal … reference"], ["m r no"], []),
    ("tax_reference", ["revenue … reference"], ["i t r", "s t r"], []),
    ("criminal_appeal", ["jail appeal", "criminal … appeal"], ["cr a", "crl a"], []),
    ("civil_appeal", ["appeal"], ["r f a", "r s a", "f a o"], []),
    ("criminal_revision", ["criminal … revision"], ["cr r"], []),
    ("civil_revision", ["revision"], [], []),
    ("review", ["review"], [], []),
    ("contempt", ["contempt"], [], []),
    ("execution", ["execution"], [], []),
    ("transfer", ["transfer"], [], []),
    ("constitutional_petition", ["writ", "constitution", "const. p", "const p"], ["c p", "w p", "c p d"], []),
    ("civil_suit", ["suit"], [], []),
    ("criminal_miscellaneous", ["criminal … misc", "criminal … application", "criminal … m a"], [], []),
    ("civil_miscellaneous", ["misc", "application"], ["c m a"], []),
]
BEFORE = {"criminal": (["criminal", "crl", "cr"], 20), "revenue": (["tax", "customs", "excise"], 30)}
# codes of procedure, which are no petitions
_PROCEDURE_CODE = r"\bc(r\.?\s?)?\.?\s?p\.?\s?c\b"
_WHOLE_WORDS = frozenset(("491", "bail", "review", "suit"))


def _phrase(phrase: str) -> str:
    kind, _, rest = phrase.partition(" … ")
    if rest:
        words, reach = BEFORE[kind]
        return rf"\b({'|'.join(words)})\b.{{0,{reach}}}" + (rest if len(rest) > 3 else _abbreviation(rest))
    bounded = phrase in _WHOLE_WORDS
    return (r"\b" if bounded or phrase.startswith("const") and phrase != "constitution" else "") + phrase.replace(".", r"\.") + (r"\b" if bounded else "")


def _abbreviation(short: str) -> str:
    if "." in short:
        return r"\b" + r"\s?".join(re.escape(x) + r"\." for x in short.split(".") if x)
    return r"\b" + r"\.?\s?".join(short.split()) + r"\b"


def rules(table: list[tuple[str, list[str], list[str], list[str]]]) -> list[tuple[str, str]]:
    """(kind, pattern) of a table of kinds like PROCEEDINGS."""
    return [(kind, "|".join([*map(_phrase, phrases), *map(_abbreviation, shorts), *(rf"[0-9]\s?-\s?{x}\b" for x in letters)])) for kind, phrases, shorts, letters in table]


def first_rule(text: Column, table: list[tuple[str, str]], default: str = "other") -> Column:
    """The name of the first rule (name, pattern) whose pattern is in the text."""
    out = None
    for name, pattern in table:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return out.otherwise(default)


def proceeding_type(case_number: Column, heading: Column | None = None) -> Column:
    """The kind of a proceeding by its number, else by the heading of its text; 'other' where no rule holds, nulls included."""
    bare = lambda c: F.regexp_replace(F.lower(collapse(F.coalesce(c, F.lit("")))), _PROCEDURE_CODE, " ")
    by_number = first_rule(bare(case_number), rules(PROCEEDINGS))
    return by_number if heading is None else F.when(by_number != "other", by_number).otherwise(first_rule(bare(heading), rules(PROCEEDINGS)))


# How a passage treats what it cites: (label, confidence, phrases), '|' between words of which any will do.
TREATMENTS = [
    ("overruled", 0.92, ["overruled|over-ruled", "is no longer good law", "stands overruled", "hereby overrule"]),
    ("per_incuriam", 0.9, ["per incuriam"]),
    ("distinguished", 0.88, ["distinguishable", "is|can be distinguished", "distinguish|distinguished|distinguishes the case|judgment|authority"]),
    ("not_followed", 0.86, ["not followed", "decline|declined|declines to follow", "cannot be followed", "do not agree with"]),
    ("dissented_from", 0.85, ["dissent|dissented|dissenting from|with", "respectfully dissent"]),
    ("approved", 0.8, ["approved", "affirmed", "upheld", "endorsed"]),
    ("followed", 0.82, ["followed", "following the dictum|ratio|principle", "in line with", "consistent with the view|ratio"]),
    ("relied_upon", 0.8, ["relied|rely|relying on|upon", "reliance is|was placed", "placed reliance"]),
    ("referred", 0.7, ["referred to", "reference may be|was made", "see also", "cited"]),
]
_SLOTS = re.compile(r"(is|can be|may be|[\w-]+)((?:\|(?:can be|may be|was|is|[\w-]+))*)")


def treatment_rules() -> list[tuple[str, str, float]]:
    """(label, pattern, confidence) with the surest first; of equally sure ones the earlier stays ahead."""
    ways = []
    for label, sure, phrases in TREATMENTS:
        spelled = [" ".join(f"({m.group(0)})" if "|" in m.group(0) else m.group(0) for m in _SLOTS.finditer(p)) for p in phrases]
        ways.append((label, r"(?i)\b(" + "|".join(spelled) + ")", sure))
    return sorted(ways, key=lambda w: -w[2])


def best_treatment(text: Column) -> Column:
    """(label, confidence) of the surest rule that holds; ties go to the earlier rule; null where none does."""
    out = None
    for label, pattern, sure in treatment_rules():
        hit = F.struct(F.lit(label).alias("label"), F.lit(sure).alias("confidence"))
        out = F.when(text.rlike(pattern), hit) if out is None else out.when(text.rlike(pattern), hit)
    return out


SECTION_MENTION = r"(?i)section ([0-9]+[A-Z]?(?:\([0-9A-Za-z]+\))*)"
ACT_MENTION = r"((?:[A-Z][a-z]+ )+(?:and [A-Z][a-z]+ )?(?:\([A-Z][a-z]+(?: [A-Z][a-z]+)?\) )?(?:Act|Ordinance|Order|Rules|Regulations), [0-9]{4})"
CITATION_MENTION = r"((?:PLD [0-9]{4} (?:SC|FSC|Lahore|Karachi|Peshawar|Islamabad|Quetta) [0-9]+)|(?:[0-9]{4} (?:SCMR|CLC|CLD|MLD|PCrLJ|PLC|PLJ|PTCL|PTD|YLR) [0-9]+))"


def mentions(text: Column, pattern: str) -> Column:
    """All first groups of a pattern, in order, each once."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def section_integer(number: Column) -> Column:
    """The leading integer of a section number."""
    return F.nullif(F.regexp_extract(F.trim(number), "^([0-9]{1,9})", 1), F.lit("")).cast("int")


def is_year_section(number: Column) -> Column:
    return F.coalesce(F.trim(number).rlike("^(1[89]|20)[0-9]{2}$"), F.lit(False))


def section_token(number: Column) -> Column:
    """Upper case without blanks and punctuation at the ends."""
    return F.upper(F.regexp_replace(F.trim(number), r"[\s.]+", ""))
