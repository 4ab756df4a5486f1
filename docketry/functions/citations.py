"""Citations as written, and the key that tells whether two of them are the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reporter codes and the seats of courts in a citation with their written forms.
REPORTERS = ["PLD", "SCMR", "CLC", "CLD", "MLD", "PCRLJ", "PLC", "PLJ", "PTCL", "PTD", "YLR", "NLR", "ALD", "PSC", "GBLR", "KLR", "SBLR"]
SEATS = {
    "SC": ["SC", "SUPREMECOURT"],
    "FSC": ["FSC", "FEDERALSHARIATCOURT"],
    "LAHORE": ["LAHORE", "LAH"],
    "KARACHI": ["KARACHI", "KAR"],
    "PESHAWAR": ["PESHAWAR", "PESH"],
    "ISLAMABAD": ["ISLAMABAD", "ISL", "ISB"],
    "QUETTA": ["QUETTA", "QUE"],
}


def citation_key(written: Column) -> Column:
    """``REPORTER:year:COURT:page`` of a written citation, null where it is none.

    Case, blanks, points, hyphens, brackets, 'p.' and 'page', and the order of reporter and year don't matter; the
    court is empty for reporters without one. A citation has exactly two numbers, a year from 1800 to 2100 and a
    page, and its letters begin with a known reporter.
    """
    upper = F.upper(F.trim(written))
    bare = F.regexp_replace(upper, r"([^A-Z]|^)(PAGE|PP|P)[^A-Z0-9]*([0-9]+)[^A-Z0-9]*$", "$1 $3")
    numbers = F.regexp_extract_all(bare, F.lit(r"([0-9]+)"), F.lit(1))
    letters = F.regexp_replace(bare, r"[^A-Z]", "")
    reporter = F.regexp_extract(letters, "^(" + "|".join(sorted(REPORTERS, key=lambda r: -len(r))) + ")", 1)
    rest = F.substr(letters, F.length(reporter) + 1)
    seats = F.create_map(*[F.lit(x) for canonical, forms in SEATS.items() for form in forms for x in (form, canonical)])
    court = F.coalesce(F.try_element_at(seats, rest), rest)
    year, page = F.try_element_at(numbers, F.lit(1)), F.try_element_at(numbers, F.lit(2))
    sound = (F.size(numbers) == 2) & (reporter != "") & year.rlike("^(18|19|20)[0-9]{2}$|^2100$") & (F.length(page) <= 9)
    return F.when(sound, F.concat_ws(":", reporter, year, court, F.regexp_replace(page, "^0+(?=[0-9])", "")))


def key_sql(written: str) -> str:
    """``citation_key`` of an SQL expression, for the checks beside the queries."""
    bare = f"regexp_replace(upper(trim({written})), '([^A-Z]|^)(PAGE|PP|P)[^A-Z0-9]*([0-9]+)[^A-Z0-9]*$', '\\1 \\3')"
    letters = f"regexp_replace({bare}, '[^A-Z]', '', 'g')"
    codes = "^(" + "|".join(sorted(REPORTERS, key=lambda r: -len(r))) + ")"
    rest = f"regexp_replace({letters}, '{codes}', '')"
    seats = " ".join(f"WHEN '{form}' THEN '{canonical}'" for canonical, forms in SEATS.items() for form in forms)
    numbers = f"regexp_extract_all({bare}, '[0-9]+')"
    return (
        f"CASE WHEN len({numbers}) = 2 AND regexp_extract({letters}, '{codes}', 1) <> '' AND regexp_matches({numbers}[1], '^(18|19|20)[0-9]{{2}}$|^2100$') AND length({numbers}[2]) <= 9 "
        f"THEN regexp_extract({letters}, '{codes}', 1) || ':' || {numbers}[1] || ':' || (CASE {rest} {seats} ELSE {rest} END) || ':' || CAST(CAST({numbers}[2] AS BIGINT) AS VARCHAR) END"
    )
