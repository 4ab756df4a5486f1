"""Ordered events: islands, gaps, the nearest earlier row, rates over look-backs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def streaks(df: DataFrame, key: list[str], order: list, hit: Column) -> DataFrame:
    """Runs of rows with ``hit``: (key, streak, length), streaks numbered in order."""
    w = Window.partitionBy(*key).orderBy(*order)
    marked = df.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    begun = marked.withColumn("_new", F.when(F.col("_hit") & ~F.coalesce(F.lag("_hit").over(w), F.lit(False)), 1).otherwise(0))
    return begun.withColumn("streak", F.sum("_new").over(w)).where("_hit").groupBy(*key, "streak").agg(F.count(F.lit(1)).alias("length"))


def streak_summary(df: DataFrame, key: list[str], bucket: Column, order: list, hit: Column) -> DataFrame:
    """(key, streaks, longest) of the runs of rows with ``hit``; keys without a run are left out.

    ``bucket`` cuts the rows of a key into stretches that follow each other in the order. Each stretch is read on its own and
    summed up by the run it begins with, the run it ends with, its longest run and its number of runs; the summaries of a key,
    one a stretch, are then folded in order, runs that go on over a border joined. No key is sorted as a whole.
    """
    w = Window.partitionBy(*key, "_bucket").orderBy(*order)
    marked = df.withColumn("_bucket", bucket).withColumn("_hit", F.coalesce(hit, F.lit(False)))
    begun = marked.withColumn("_n", F.row_number().over(w)).withColumn("_new", F.when(F.col("_hit") & ~F.coalesce(F.lag("_hit").over(w), F.lit(False)), 1).otherwise(0))
    islands = begun.withColumn("_island", F.sum("_new").over(w)).groupBy(*key, "_bucket", "_island").agg(F.count_if("_hit").alias("_len"), F.min(F.when(F.col("_hit"), F.col("_n"))).alias("_from"), F.max(F.when(F.col("_hit"), F.col("_n"))).alias("_to"), F.max("_n").alias("_last"))
    stretch = islands.groupBy(*key, "_bucket").agg(
        F.max("_last").alias("rows"), F.coalesce(F.max(F.when(F.col("_from") == 1, F.col("_len"))), F.lit(0)).alias("head"), F.max("_len").alias("longest"),
        F.count_if(F.col("_len") > 0).alias("streaks"), F.max(F.struct("_last", F.when(F.col("_to") == F.col("_last"), F.col("_len")).otherwise(0).alias("run")))["run"].alias("tail"),
    )
    parts = F.array_sort(F.collect_list(F.struct("_bucket", "rows", "head", "longest", "streaks", "tail")))
    nought = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("streaks", "longest", "tail")])

    def fold(a: Column, x: Column) -> Column:
        joined = (a["tail"] > 0) & (x["head"] > 0)
        return F.struct(
            (a["streaks"] + x["streaks"] - joined.cast("bigint")).alias("streaks"), F.greatest(a["longest"], x["longest"], F.when(joined, a["tail"] + x["head"]).otherwise(0)).cast("bigint").alias("longest"),
            F.when(x["tail"] == x["rows"], a["tail"] + x["tail"]).otherwise(x["tail"]).cast("bigint").alias("tail"),
        )

    return stretch.groupBy(*key).agg(F.aggregate(parts, nought, fold).alias("_s")).select(*key, "_s.streaks", "_s.longest").where("streaks > 0")


def number_gaps(df: DataFrame, key: str, number: str, width: int = 1 << 16) -> DataFrame:
    """(key, after, before) of the distinct numbers of each key behind which numbers are missing; ``before`` is null for the greatest.

    Numbers are compared within ranges of ``width``; the ends of the ranges, one row each, are compared among themselves.
    """
    held = df.select(key, number).where(F.col(number).isNotNull()).distinct().withColumn("_range", F.floor(F.col(number) / width))
    inner = held.select(key, "_range", F.col(number).alias("after"), F.lead(number).over(Window.partitionBy(key, "_range").orderBy(number)).alias("before"))
    ends = held.groupBy(key, "_range").agg(F.min(number).alias("_low"), F.max(number).alias("after"))
    border = ends.select(key, "after", F.lead("_low").over(Window.partitionBy(key).orderBy("_range")).alias("before"))
    return inner.where("before > after + 1").select(key, "after", "before").unionByName(border.where("before is null or before > after + 1"))


def gaps(df: DataFrame, key: list[str], number: str, step: int) -> DataFrame:
    """(key, after, before) of consecutive distinct numbers that are more than ``step`` apart."""
    distinct = df.select(*key, number).where(F.col(number).isNotNull()).distinct()
    nxt = F.lead(number).over(Window.partitionBy(*key).orderBy(number))
    return distinct.select(*key, F.col(number).alias("after"), nxt.alias("before")).where(F.col("before") - F.col("after") > step)


def nearest_before(left: DataFrame, right: DataFrame, key: str, at: str, value: str, tie: str) -> DataFrame:
    """As-of join: each left row with the last right value strictly before it under the same key, null where there is none.

    One union, one sort by (key, time) and a running last value: no pair of rows is formed.
    """
    a = left.select(key, at, tie, F.lit(None).cast(dict(right.dtypes)[value]).alias("_v"), F.lit(0).alias("_side"))
    b = right.select(key, at, F.lit(None).cast(dict(left.dtypes)[tie]).alias(tie), F.col(value).alias("_v"), F.lit(1).alias("_side"))
    w = Window.partitionBy(key).orderBy(F.col(at), F.col("_side")).rowsBetween(Window.unboundedPreceding, -1)
    return a.unionByName(b).withColumn("nearest", F.last("_v", ignorenulls=True).over(w)).where("_side = 0").select(key, at, tie, "nearest")
