"""Rules over the lines of a text, and over numerals, names and titles: Arrow UDFs where a rule has state."""

from __future__ import annotations

from bisect import bisect_left
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# How long a run of question marks means lost characters, and what a line with such a run may have beside it
# and still count as lost: fewer than 3 Latin words of 3 letters, none of 7 letters, at most 15 other characters.
RUN, SHORT_WORDS, LONG_WORD, REMAINS = r"\?{4,}", r"[A-Za-z]{3,}", r"[A-Za-z]{7,}", 15
ARABIC_BLOCK = r"[\x{0600}-\x{06FF}]"
SIGNED = r"(?i)^\s*(\(sd/?-?\)|sd/?-?|announced\.?|pronounced\.?|j\.|judge\.|.{0,60}\bchief\s+justice\s*\.?)\s*$"


def line_class(line: Column) -> Column:
    """One letter for what a line is: B blank, D damaged but readable, Q lost, S signature, L Latin, U Arabic script alone, O other."""
    words = F.regexp_count(line, F.lit(SHORT_WORDS))
    rest = F.length(F.regexp_replace(line, r"[?\s]", ""))
    signed = line.rlike(SIGNED)
    return (
        F.when(F.trim(F.regexp_replace(line, r"\s+", " ")) == "", "B")
        .when(line.rlike(RUN) & (signed | (words >= 3) | line.rlike(LONG_WORD) | (rest > REMAINS)), "D")
        .when(line.rlike(RUN), "Q")
        .when(signed, "S")
        .when(words > 0, "L")
        .when(line.rlike(ARABIC_BLOCK), "U")
        .otherwise("O")
    )


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "\r\n", "\n"), "\n")


def line_classes(text: Column) -> Column:
    """The classes of the lines of a text as one string."""
    return F.array_join(F.transform(_lines(text), line_class), "")


#: Lost lines stand after the last signature alone, or, unsigned, after the last Latin line alone; nothing else follows.
LOST_TAIL = "^([^QD]*S[QUB]*|([^QDS]*L)?[QUB]+)$"


def mojibake_class(text: Column) -> Column:
    """none; headnote, if only lines after the body are lost; body, if the body itself is damaged. Null and empty texts have none."""
    return F.when(~F.coalesce(text.rlike(RUN), F.lit(False)), "none").when(line_classes(text).rlike(LOST_TAIL), "headnote").otherwise("body")


def strip_lost_tail(text: Column) -> Column:
    """The text without the lost lines after its last signature, or, unsigned, without those at its end; '' for null."""
    body = F.coalesce(text, F.lit(""))
    classes = line_classes(body)
    signed = F.length(F.regexp_extract(classes, "^(.*S)?", 0))
    kept = F.filter(_lines(body), lambda x, i: (i < signed) | ~line_class(x).isin("Q", "U", "B"))
    unsigned = F.slice(_lines(body), F.lit(1), F.length(F.regexp_replace(classes, "[QUB]+$", "")))
    out = F.array_join(F.when(signed > 0, kept).otherwise(unsigned), "\n")
    return F.concat(F.regexp_replace(out, r"\s+$", ""), F.when(F.endswith(body, F.lit("\n")), "\n").otherwise(""))


# Whom copies go to, and the words that open the list of them.
ADDRESSEE = r"(?i)^\s*(\(?[0-9]{1,2}[.)]\s*)?(the\s+)?(secretary|secretaries|commissioner|director|deputy|registrar|accountant|chief|inspector|superintendent|chairman|manager|all\b|p\.?s\.? to|copy|master file|office copy|librarian|editor|press)\b.*$"
FORWARDED = r"(?i)\b(copy (is )?forwarded|copy to|distribution|forwarded for information|no\.? and date even)\b"


def strip_distribution(text: Column) -> Column:
    """The text without the block of addressees at its end: from the first forwarding line on that only addressees and blank lines follow."""
    kinds = F.array_join(F.transform(_lines(text), lambda x: F.when(F.trim(x) == "", "B").when(x.rlike(FORWARDED), "F").when(x.rlike(ADDRESSEE), "A").otherwise("O")), "")
    block = F.regexp_extract(kinds, "(F[BFA]*A[BFA]*)$", 1)
    cut = F.length(kinds) - F.length(block)
    return F.when((F.length(block) > 0) & (cut > 0), F.regexp_replace(F.array_join(F.slice(_lines(text), F.lit(1), cut), "\n"), r"\s+$", "")).otherwise(text)


_VALUES = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def numeral(token: Column) -> Column:
    """A Roman or Arabic numeral as a number, by the rule that a letter before a greater one is taken off, in whatever order they stand; null where it is neither, or 0."""
    t = F.upper(F.trim(token))
    letters = F.split(t, "")
    worth = F.create_map(*[F.lit(x) for k, v in _VALUES.items() for x in (k, v)])
    values = F.transform(F.filter(letters, lambda c: c != ""), lambda c: F.try_element_at(worth, c))
    total = F.aggregate(F.reverse(values), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")), lambda a, v: F.struct(F.when(v < a["last"], a["sum"] - v).otherwise(a["sum"] + v).alias("sum"), v.alias("last")), lambda a: a["sum"])
    return F.when(t.rlike("^[0-9]{1,9}$"), t.try_cast("int")).when(t.rlike("^[IVXLCDM]+$"), F.nullif(total, F.lit(0)))


def rising_end_of(numbers) -> int:
    """The smallest possible end of a longest strictly rising subsequence; 0 for none."""
    tails: list[int] = []
    for n in numbers if numbers is not None else []:
        if n is not None:
            k = bisect_left(tails, n)
            tails[k : k + 1] = [n]
    return int(tails[-1]) if tails else 0


def similarity_of(a: str | None, b: str | None) -> float:
    """Ratio of matching blocks of two whole texts, white space collapsed, to three places."""
    x, y = " ".join((a or "").split()), " ".join((b or "").split())
    return round(SequenceMatcher(None, x, y, autojunk=False).ratio(), 3)


CORAM = r"(?im)^[ \t]*(coram|bench|before|present)[ \t]*[.:—-]+[ \t]*([^\n]*?)[ \t]*$"


def bench(text: Column) -> Column:
    """The judges of the first coram line of a text, each once, titles off; [] where there is none."""
    line = F.regexp_extract(F.coalesce(text, F.lit("")), CORAM, 2)
    parts = F.split(line, r"\s*(?:,|;|\band\b|&)\s*")
    bare = F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), r"(?i)^((mr|mrs|ms|dr|hon'?ble|justice)\.?\s+)+", ""), r"(?i)^[ .]+|,?\s*\b(jj?|c\.?j)\.?$|[ .]+$", ""))
    return F.array_distinct(F.filter(bare, lambda x: (F.length(x) > 3) & ~x.rlike("[0-9]")))


def _udf(fn, kind: str):
    def column(*args: Column) -> Column:
        if len(args) == 1:
            @F.pandas_udf(kind)
            def run_one(a: pd.Series) -> pd.Series:
                return pd.Series([fn(None if isinstance(v, float) and v != v else v) for v in a], dtype=object)

            return run_one(*args)

        @F.pandas_udf(kind)
        def run_two(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series([fn(x, y) for x, y in zip(a, b)], dtype=object)

        return run_two(*args)

    return column


rising_end = _udf(rising_end_of, "int")
similarity = _udf(similarity_of, "double")


def title_tokens(title: Column) -> Column:
    """Words of a title that tell it apart, sorted: lower case, without the kind of instrument, years and small words."""
    words = F.split(F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", " ")), " ")
    plain = ["", "the", "of", "and", "for", "to", "in", "an", "a", "act", "ordinance", "order", "rules", "regulations", "code"]
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: ~w.isin(plain) & ~w.rlike("^(18|19|20)[0-9]{2}$"))))


def title_year(title: Column) -> Column:
    return F.nullif(F.regexp_extract(title, r"\b((?:18|19|20)[0-9]{2})\b", 1), F.lit("")).cast("int")


def title_relation(a: Column, b: Column) -> Column:
    """same, year_differs, different or unknown (a title without telling words): equal or contained words, or a Jaccard of 0.75."""
    x, y = title_tokens(a), title_tokens(b)
    both, any_ = F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))
    alike = (both == F.least(F.size(x), F.size(y))) & (both >= 2) | (both / F.greatest(any_, F.lit(1)) >= 0.75)
    return (
        F.when((F.size(x) == 0) | (F.size(y) == 0), "unknown")
        .when(alike & (title_year(a).isNull() | title_year(b).isNull() | (title_year(a) == title_year(b))), "same")
        .when(alike, "year_differs")
        .otherwise("different")
    )


def ocr_name(name: Column) -> Column:
    """Digits inside a word of letters back to the letters they stand for; a word that begins with two of 1, l and I begins with Il."""
    words = F.transform(
        F.split(name, " "),
        lambda w: F.when(~(w.rlike("[A-Za-z]") & w.rlike("[0-9]")), w).when(w.rlike("^[1lI]{2}[a-z]+$"), F.concat(F.lit("Il"), F.substr(w, F.lit(3)))).otherwise(F.translate(w, "1058", "losB")),
    )
    return F.array_join(words, " ")
