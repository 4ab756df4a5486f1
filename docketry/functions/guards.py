"""What a captured judgment holds: the record of a case, or the surroundings of one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits, phrases of subscriptions and logins, and lines that a viewer puts before a case.
FULL_READY, THIN, MEDIUM, DOMINANT, LEAST_TAIL = 5000, 400, 1200, 0.25, 300
CHROME = r"(?i)\b(obtaining\s+subscription|update\s+subscriber|update\s+subscription|subscriber\s+account|i\s+agree\s+with\s+the\s+terms)\b"
PASSWORD_FIELD = r"(?i)<input\b[^>]*\btype\s*=\s*['\"]password['\"]"
VIEWER_LINE = r"(?i)^\s*([×x]+|case\s+description|bookmark\s+this\s+case|update\s+subscriber\b.*|obtaining\s+subscription\b.*|citation\s*name\s*:.*|notes?\s+on\s+cases?)\s*$"
# Lines that a judgment has: its bench, its court, its parties, its heading.
STRUCTURE = r"(?im)^\s*(before|coram)\b|^\s*in\s+the\s+[A-Z][^\n]{0,160}\bcourt\b|^[^\n]{0,220}\b(versus|vs\.?|v\.)\s|^\s*judge?ment\b|^\s*held\s*[:.-]"
HEARING = r"(?im)^[^\n]*\b(dates?\s*(\(\s*s\s*\))?\s+of\s+[hb]earing|date\s+of\s+institution)\s*:[^\n]*$"
COUNSEL = r"(?i)^.{1,240}?\bfor\s+(the\s+)?(petitioner|respondent|appellant|plaintiff|defendant|accused|complainant)\s*[.,]?\s*$"
ORDER_LINE = r"(?im)^\s*(judgment|judgement|order)\b"
HEADNOTES = r"(?i)\bnotes?\s+on\s+cases?\b"


def compact_length(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", ""))


def is_structured(text: Column) -> Column:
    """Whether a line of the text is one that judgments have."""
    return F.coalesce(text.rlike(STRUCTURE), F.lit(False))


def chrome_share(text: Column) -> Column:
    """Share of the characters, white space aside, that are phrases of subscriptions and logins; 1 for no text."""
    whole = compact_length(text)
    left = compact_length(F.regexp_replace(F.coalesce(text, F.lit("")), CHROME, " "))
    return F.when(whole > 0, (whole - left) / whole).otherwise(1.0)


def chrome_dominates(text: Column, html: Column | None = None) -> Column:
    """Whether such phrases, or a field for a password, are what a text without the lines of a judgment is about."""
    body = F.coalesce(text, F.lit(""))
    said = body.rlike(CHROME)
    field = F.lit(False) if html is None else F.coalesce(html.rlike(PASSWORD_FIELD), F.lit(False))
    n = compact_length(body)
    return (said | field) & ((n < THIN) | (said & (chrome_share(body) >= DOMINANT)) | (~is_structured(body) & (field | (n < MEDIUM))))


def strip_viewer_lines(text: Column) -> Column:
    """The text from its first line on that neither is blank nor belongs to a viewer; '' for null."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"), "\n")
    kinds = F.array_join(F.transform(lines, lambda x: F.when((F.trim(x) == "") | x.rlike(VIEWER_LINE), "v").otherwise("t")), "")
    at = F.instr(kinds, "t")
    return F.when(at > 0, F.trim(F.array_join(F.slice(lines, F.greatest(at, F.lit(1)), F.size(lines)), "\n"))).otherwise("")


def _safe(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tail_after_hearing(text: Column) -> Column:
    """Characters behind the last line of a hearing, lines of counsel aside; null without such a line."""
    body = _safe(text)
    rest = F.regexp_extract(body, r"(?is)^.*\n[^\n]*(?:dates?\s*(?:\(\s*s\s*\))?\s+of\s+[hb]earing|date\s+of\s+institution)\s*:[^\n]*\n(.*)$", 1)
    kept = F.filter(F.split(rest, "\n"), lambda x: (F.trim(x) != "") & ~x.rlike(COUNSEL))
    return F.when(body.rlike(HEARING), F.length(F.array_join(F.transform(kept, F.trim), "")))


def is_headnote_only(text: Column) -> Column:
    """A text that ends soon after its hearing: what follows, without the lines of counsel, is under 300 characters."""
    return F.coalesce(tail_after_hearing(text) < LEAST_TAIL, F.lit(False))


def is_full_ready(text: Column, judges: Column) -> Column:
    """Long enough for a judgment, with judges, and with a body behind its headnotes."""
    return (F.size(F.coalesce(judges, F.array().cast("array<string>"))) > 0) & (F.length(_safe(text)) >= FULL_READY) & ~is_headnote_only(text)


def guard_flags(text: Column, html: Column | None = None) -> Column:
    """The faults of a judgment's text, in order: empty, chrome, headnotes, no_structure, thin."""
    body = _safe(text)
    rules = [
        ("empty", F.trim(body) == ""), ("chrome", chrome_dominates(text, html)), ("headnotes", is_headnote_only(text)), ("no_structure", (F.trim(body) != "") & ~is_structured(body)), ("thin", compact_length(body).between(1, THIN - 1)),
    ]
    return F.array_compact(F.array(*[F.when(when, name) for name, when in rules]))


COURT_LINE = r"(?im)^\s*(?:in the )?([A-Za-z' ]*(?:Court|Tribunal)(?: of [A-Za-z]+)?(?:,? [A-Z][a-z]+)?)\s*$"


def header_court(text: Column) -> Column:
    """The court that the first line of a court's form names, whatever its case; null where none does."""
    found = F.regexp_replace(F.trim(F.regexp_extract(text, COURT_LINE, 1)), r"(?i)^(in )?the ", "")
    return F.nullif(F.initcap(F.lower(F.regexp_replace(found, r"\s+", " "))), F.lit(""))


def bracket_court(text: Column, citation: str) -> Column:
    """The court in the brackets that directly follow a citation of a pattern, if it names a forum or a seat."""
    name = F.trim(F.regexp_extract(text, citation + r"[\s().,;:0-9-]*\[\s*([A-Za-z][A-Za-z\s.&,()-]{1,78}?)\s*\]", 1))
    return F.when(name.rlike(r"(?i)\b(court|tribunal|bench|commission|board)\b|^(lahore|karachi|peshawar|quetta|islamabad|supreme court|sc)$"), name)


REFERRED = r"[\s,;:)\]]*(?:\(?\b(?:ref|rel|relied|referred|distinguished|foll|followed)\b\.?)"
ALSO_REPORTED = r"(?i)(?:also reported (?:as|in)|equivalent citations?:?|=)\s*"
PARTY_ROLE = r"(?i)^\W*(?:\.{2,}|…)?\s*(petitioners?|appellants?|plaintiffs?|applicants?)\W*$"
OTHER_ROLE = r"(?i)^\W*(?:\.{2,}|…)?\s*(respondents?|defendants?|opponents?)\W*$"
VERSUS_LINE = r"(?i)^\W*(versus|vs\.?|v\.?)\W*$"


def order_sheet_title(text: Column) -> Column:
    """'A v. B' of a text whose lines give, in order, a name, a petitioner's role, 'versus', a name and a respondent's role."""
    lines = F.filter(F.transform(F.split(_safe(text), "\n"), F.trim), lambda x: x != "")
    kinds = F.array_join(F.transform(lines, lambda x: F.when(x.rlike(PARTY_ROLE), "P").when(x.rlike(OTHER_ROLE), "R").when(x.rlike(VERSUS_LINE), "V").otherwise("n")), "")
    at = F.regexp_instr(kinds, F.lit("nPVnR"))
    return F.when(at > 0, F.concat(F.get(lines, at - 1), F.lit(" v. "), F.get(lines, at + 2)))
