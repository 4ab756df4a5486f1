"""Names, numbers and sections of statutes and instruments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.lines import numeral
from docketry.functions.text import collapse

# Forms of section numbers, and how far a number can be one of an act.
ZERO_SECTION, TARIFF_CHAPTER, YEAR_SECTION = r"(?i)^0[A-Z]?$", r"(?i)^0[EI]$", r"^(1[89]|20)[0-9]{2}$"
DATE_HEAD = r"^\s*[0-9]{1,2}\.[0-9]{1,2}\.(19|20)[0-9]{2}"
MOST_SECTIONS = 5000


def statute_key(name: Column) -> Column:
    """A name for comparison: lower case without points, commas and brackets, 'the' and 'under the' at its head taken off."""
    low = F.regexp_replace(F.lower(F.trim(F.coalesce(name, F.lit("")))), r"[.,()]", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(low, r"\s+", " "), r"^(in|under|of|to) the ", ""), r"^the ", "")


def yearless(key: Column) -> Column:
    return F.regexp_replace(key, r" ?(19|20)[0-9]{2} ?$", "")


def cleaned_name(name: Column, year: Column) -> Column:
    """A name that no list knows: blanks collapsed, stops at its ends off, and its year put behind it where it names none."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(name), r"^[.,;]+|[.,;]+$", ""), r"\s+", " ")
    return F.when(year.isNotNull() & ~bare.rlike(r"\b(18|19|20)[0-9]{2}\b"), F.concat(bare, F.lit(", "), year.cast("string"))).otherwise(bare)


def is_zero_section(number: Column) -> Column:
    """'0' and '0A' are no sections; '0E' and '0I' are chapters of a tariff."""
    return F.coalesce(F.trim(number).rlike(ZERO_SECTION) & ~F.trim(number).rlike(TARIFF_CHAPTER), F.lit(False))


def starts_with_date(text: Column) -> Column:
    """A footnote's date where a heading should be."""
    return F.coalesce(text.rlike(DATE_HEAD), F.lit(False))


def is_bogus_number(number: Column) -> Column:
    """Blank, or a number beyond any act."""
    n = F.nullif(F.regexp_extract(F.coalesce(number, F.lit("")), "([0-9]{1,9})", 1), F.lit("")).cast("int")
    return (F.trim(F.coalesce(number, F.lit(""))) == "") | F.coalesce(n > MOST_SECTIONS, F.lit(False))


# What names that are no names look like.
FILE_TOKENS = r"pdffiles|viewerjs|uy2f|lgu0x|%3d|%2f|\badministrator[\s-]+act\b|\.(pdf|html?|php|aspx)\b"
FILE_SIGNATURES = r"JFIF|%PDF|\x00"


def is_clause_fragment(name: Column) -> Column:
    low = F.lower(collapse(F.coalesce(name, F.lit(""))))
    return low.rlike(r"^means the |^further to amend|(^| )further to amend( |$)")


def is_garbage_name(name: Column) -> Column:
    """No name, bytes of a file, or less than 85 % printable characters."""
    n = F.coalesce(name, F.lit(""))
    odd = F.regexp_count(n, F.lit(r"[\p{C}\p{Z}&&[^ ]]"))
    return (n == "") | n.rlike(FILE_SIGNATURES) | (odd > 0.15 * F.length(n))


def is_fragment_name(name: Column) -> Column:
    """A clause, garbage, or what is left of a url or file's name."""
    n = collapse(F.coalesce(name, F.lit("")))
    tight = F.regexp_replace(n, r"\s", "")
    twice = (F.length(n) - F.length(F.replace(n, F.lit("="), F.lit(""))) >= 2) & ~F.contains(n, F.lit(" "))
    return (n != "") & (is_clause_fragment(n) | is_garbage_name(n) | F.lower(n).rlike(FILE_TOKENS) | tight.rlike(r"^[A-Za-z0-9+/=_-]{20,}$") | n.rlike("%[0-9A-Fa-f]{2}") | twice)


ACT_NUMBER = r"(?i)\bact\s+no\.?\s*([IVXLCDM]+|[0-9]{1,4})\s+of\s+((?:18|19|20)[0-9]{2})\b"


def act_number(text: Column) -> Column:
    """Struct (number, year) of the first act number of a text; null where there is none."""
    number = numeral(F.nullif(F.regexp_extract(text, ACT_NUMBER, 1), F.lit("")))
    return F.when(number.isNotNull(), F.struct(number.alias("number"), F.regexp_extract(text, ACT_NUMBER, 2).cast("int").alias("year")))


# How instruments are referred to, and how a reference is written out.
MENTIONS = {
    "SRO": (r"(?i)\bs\.?\s*r\.?\s*o\.?\s*(?:no\.?\s*)?([0-9]+\s*(?:\([IVX]+\))?)\s*/\s*((?:18|19|20)[0-9]{2})", "S.R.O. ", "/"),
    "ACT_NO": (r"(?i)\bact\s+no\.?\s*([IVXLCDM]+|[0-9]{1,4})\s+of\s+((?:18|19|20)[0-9]{2})\b", "Act No. ", " of "),
    "ORDINANCE_NO": (r"(?i)\bordinance\s+no\.?\s*([IVXLCDM]+|[0-9]{1,4})\s+of\s+((?:18|19|20)[0-9]{2})\b", "Ordinance No. ", " of "),
}


def instrument_mention(raw: Column, kind: str) -> Column:
    """A reference of a kind in its one form; what does not fit the kind is only collapsed."""
    pattern, head, between = MENTIONS[kind]
    number = F.upper(F.regexp_replace(F.regexp_extract(raw, pattern, 1), r"\s+", ""))
    return F.when(raw.rlike(pattern), F.concat(F.lit(head), number, F.lit(between), F.regexp_extract(raw, pattern, 2))).otherwise(collapse(F.coalesce(raw, F.lit(""))))


TITLE = r"((?:[A-Z][A-Za-z]+ )(?:(?:[A-Z][A-Za-z]+|and|of|for|the) ){0,8}(?:\([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)*\) )?(?:Act|Ordinance|Order|Rules|Regulations|Code),? (?:18|19|20)[0-9]{2})"
CALLED = r"may be called (?:the )?" + TITLE


def called_titles(text: Column) -> Column:
    """The titles that a text says it may be called by."""
    return F.regexp_extract_all(text, F.lit(CALLED), F.lit(1))


SEGMENT_HEAD = r"^(?:THE )?[A-Z][A-Z ()]+ (?:ACT|ORDINANCE|ORDER|RULES|REGULATIONS|CODE),? (?:18|19|20)[0-9]{2}\.?$|^NOTIFICATION$"


def segments(text: Column) -> Column:
    """A gazette cut before each line that heads an act: array of (head, body); what stands before the first head has the head ''."""
    lines = F.split(text, "\n")
    marked = F.array_join(F.transform(lines, lambda x: F.when(F.trim(x).rlike(SEGMENT_HEAD), F.concat(F.lit("\x01"), x)).otherwise(x)), "\n")
    parts = F.filter(F.split(marked, "\x01"), lambda p: F.trim(p) != "")
    first = lambda p: F.trim(F.split_part(p, F.lit("\n"), F.lit(1)))
    return F.transform(parts, lambda p: F.struct(F.when(first(p).rlike(SEGMENT_HEAD), first(p)).otherwise("").alias("head"), p.alias("body")))


EMBEDDED_HEAD = r"(?m)^([0-9]{1,3}[A-Z]?)\. +[A-Z]"


def embedded_headings(text: Column) -> Column:
    """Numbers of headings that stand at line starts inside a section's body."""
    return F.regexp_extract_all(text, F.lit(EMBEDDED_HEAD), F.lit(1))


SCHEDULE_HEAD = r"(?m)^\s*(?:THE )?(?:FIRST |SECOND |THIRD |FOURTH )?(?:SCHEDULE|ANNEXURE|APPENDIX|Schedule|Annexure|Appendix)\b[^\n]*$"


def peel_schedule(text: Column) -> Column:
    """Struct (body, schedule): a text cut before the last line that heads a schedule and has text behind it; schedule null without one."""
    at = F.regexp_instr(text, F.lit(r"(?s)\n\s*(?:THE )?(?:FIRST |SECOND |THIRD |FOURTH )?(?:SCHEDULE|ANNEXURE|APPENDIX|Schedule|Annexure|Appendix)\b[^\n]*\n.*\S"))
    return F.struct(F.when(at > 1, F.rtrim(F.substr(text, F.lit(1), at - 1))).otherwise(text).alias("body"), F.when(at > 1, F.trim(F.regexp_replace(F.substr(text, at), r"^\s+", ""))).alias("schedule"))


def zero_class(text: Column) -> Column:
    """What the text of a section '0' is: A a clause '0)', B a decimal '0.5', C other text behind '0.', else unknown."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t.rlike(r"^0\s*\)"), "A").when(t.rlike(r"^0\s*\.\s*[0-9]"), "B").when(t.rlike(r"^0\s*\."), "C").otherwise("unknown")


def reporter_code(reporter: Column) -> Column:
    """Upper case without blanks and points."""
    return F.upper(F.regexp_replace(F.coalesce(reporter, F.lit("")), r"[\s.]", ""))


CASE_CODE = r"CaseName=([0-9]{4}[A-Za-z]{1,8}[0-9]{1,6})(?:[^0-9A-Za-z]|$)"


def case_code(url: Column) -> Column:
    """The code of a case in the query of a url."""
    return F.upper(F.nullif(F.regexp_extract(url, CASE_CODE, 1), F.lit("")))


CASE_NUMBER = r"(?m)((?:[A-Z][A-Za-z.()&']*\.? *){1,7}Nos?\.? *[A-Z]? *-? *[0-9]+(?:[-/ ][A-Z])?(?: *- *[A-Z]\b)? *(?:of|/) *(?:19|20)[0-9]{2})"


def case_number(text: Column, listed: Column) -> Column:
    """The number of a case: as listed, else the first in its text."""
    return F.coalesce(F.nullif(F.when(listed.rlike("[0-9]"), collapse(listed)), F.lit("")), F.nullif(collapse(F.regexp_extract(text, CASE_NUMBER, 1)), F.lit("")))


def unreported_identity(court: Column, number: Column, day: Column, text_hash: Column) -> Column:
    """What an unreported judgment is known by; without a number its text's hash keeps two apart."""
    when = F.date_format(day, "yyyy-MM-dd")
    head = F.concat(F.lit("UNREPORTED "), F.left(court, F.lit(20)), F.lit(" "))
    named = F.concat(head, F.left(number, F.lit(140)), F.coalesce(F.concat(F.lit(" ("), when, F.lit(")")), F.lit("")))
    return F.coalesce(named, F.concat(head, F.coalesce(when, F.lit("undated")), F.lit(" #"), F.left(F.coalesce(text_hash, F.lit("")), F.lit(12))))


FORBIDDEN_KEYS = ["cookies", "cookie", "storage_state", "storageState", "headers", "authorization", "password", "token", "api_key", "apikey"]


def payload(json: Column, longest: int = 20_000) -> Column:
    """The string fields of a JSON object as a map: forbidden keys and NULs out, long values replaced by length and hash."""
    fields = F.from_json(F.replace(json, F.lit("\\u0000"), F.lit("")), "map<string,string>")
    short = lambda v: F.when(F.length(v) > longest, F.to_json(F.struct(F.length(v).alias("_len"), F.sha2(collapse(v), 256).alias("_sha256_canonical")))).otherwise(F.translate(v, "\x00", ""))
    return F.transform_values(F.map_filter(fields, lambda k, _: ~k.isin(FORBIDDEN_KEYS)), lambda _, v: short(v))


def query_fields(fields: Column) -> Column:
    """The fields of a query that are set, trimmed, as a map."""
    return F.map_filter(F.transform_values(fields, lambda _, v: F.trim(v)), lambda _, v: v.isNotNull() & (v != ""))


CITATION_FIELDS = ["citation", "reporter", "year", "page"]


def is_citation_only(fields: Column) -> Column:
    """A query that sets fields of a citation and no other."""
    set_ = F.map_keys(query_fields(fields))
    return (F.size(set_) > 0) & (F.size(F.array_except(set_, F.array(*map(F.lit, CITATION_FIELDS)))) == 0)


def in_shingles(text: Column, held: Column, words: int = 12, samples: int = 8) -> Column:
    """Share of up to ``samples`` evenly spaced runs of ``words`` words of a text that stand in another; null for texts without a run."""
    norm = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    w = F.split(norm(text), " ")
    last = F.size(w) - words
    at = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: F.floor(i * last / (samples - 1)).cast("int")))
    runs = F.transform(at, lambda i: F.array_join(F.slice(w, i + 1, words), " "))
    hay = F.concat(F.lit(" "), norm(held), F.lit(" "))
    found = F.size(F.filter(runs, lambda r: F.contains(hay, F.concat(F.lit(" "), r, F.lit(" ")))))
    return F.when(last >= 0, F.struct(found.alias("found"), F.size(runs).alias("runs")))
