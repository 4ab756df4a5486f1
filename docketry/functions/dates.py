"""Dates in texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
# The forms in which dates are written.
DAY_FIRST = rf"([0-9]{{1,2}}) ({MONTHS}),? ([0-9]{{4}})"
MONTH_FIRST = rf"({MONTHS}) ([0-9]{{1,2}}), ([0-9]{{4}})"
NUMERIC = r"([0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4})"
ISO = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"


def find_dates(text: Column, low: int = 1947, high: int = 2100) -> Column:
    """All dates of a text in any of the forms, between the years, sorted and distinct."""
    named = F.transform(F.regexp_extract_all(text, F.lit(f"({DAY_FIRST})"), F.lit(1)), lambda x: F.try_to_timestamp(F.regexp_replace(x, ",", ""), F.lit("d MMMM yyyy")).cast("date"))
    months = F.transform(F.regexp_extract_all(text, F.lit(f"({MONTH_FIRST})"), F.lit(1)), lambda x: F.try_to_timestamp(x, F.lit("MMMM d, yyyy")).cast("date"))
    numeric = F.transform(F.regexp_extract_all(text, F.lit(NUMERIC), F.lit(1)), lambda x: F.try_to_timestamp(F.regexp_replace(x, "[/-]", "."), F.lit("d.M.yyyy")).cast("date"))
    iso = F.transform(F.regexp_extract_all(text, F.lit(ISO), F.lit(1)), lambda x: F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).cast("date"))
    dates = F.filter(F.concat(named, months, numeric, iso), lambda d: d.isNotNull() & F.year(d).between(low, high))
    return F.array_sort(F.array_distinct(dates))


def date_in_text(day: Column, text: Column) -> Column:
    return F.coalesce(F.array_contains(find_dates(text), day), F.lit(False))
