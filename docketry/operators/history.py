"""Histories of changing attributes: one row per version with the period in which it held.

Gaps and islands over all snapshots: captures of the same key and date are reduced to the latest one before the
shuffle, a lag comparison of the attribute hash marks changes, a running sum of the marks numbers the islands,
the island's first date opens the version and the next island's start closes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters that count as white space, no-break and other Unicode spaces included.
SPACES = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def text_key(text: Column) -> Column:
    """What of a text counts in a comparison: all of it but white space, as a 128-bit hash; null stays apart from ''."""
    bare = F.regexp_replace(text, SPACES, "")
    return F.coalesce(F.md5(bare), F.lit("null"))


def version_history(
    df: DataFrame,
    key: list[str],
    valid_from: str,
    recorded_at: str,
    tie: str,
    attribute: Column,
) -> DataFrame:
    """Versions of each key: the key, ``version_no`` (int, from 1), ``valid_from`` and ``valid_to`` (dates).

    Rows without ``valid_from`` or with a null in the key are no part of a history. Of rows with the same key and
    date the one with the latest ``recorded_at`` counts; null ``recorded_at`` is the earliest, and ties go to the
    greatest ``tie``. ``valid_to`` is the day before the next version begins, null for the last. An empty table
    gives an empty history. After the reduction a key has at most one row a day, so that no window is larger than
    the days in the calendar of the data, however many captures a key has.
    """
    rows = df.select(*key, F.col(valid_from).alias("_from"), F.col(recorded_at).alias("_at"), F.col(tie).alias("_tie"), attribute.alias("_attr"))
    rows = rows.where(F.col("_from").isNotNull())
    for k in key:
        rows = rows.where(F.col(k).isNotNull())
    daily = rows.groupBy(*key, "_from").agg(F.max(F.struct("_at", "_tie", "_attr")).getField("_attr").alias("_attr"))
    in_order = Window.partitionBy(*key).orderBy("_from")
    before = F.lag("_attr").over(in_order)
    marked = daily.withColumn("_new", F.when(before.isNull() | (before != F.col("_attr")), 1).otherwise(0))
    # only rows that begin an island are needed from here on; their running sum is the island's number
    islands = marked.where("_new = 1").withColumn("version_no", F.sum("_new").over(in_order).cast("int"))
    following = F.lead("_from").over(in_order)
    return islands.select(*key, "version_no", F.col("_from").alias("valid_from"), F.date_sub(following, 1).alias("valid_to"))
