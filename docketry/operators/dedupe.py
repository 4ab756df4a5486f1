"""Duplicates: groups, keepers, the longest of equals, provenance by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_duplicates(df: DataFrame, id_col: str, key: Column) -> DataFrame:
    """(key, copies, keeper) of the keys with two rows or more; the keeper has the smallest id. Aggregated before the shuffle."""
    return df.select(F.col(id_col).alias("_id"), key.alias("key")).where(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("keeper")).where("copies > 1")


def longest_wins(df: DataFrame, key: str, length: Column, id_col: str) -> DataFrame:
    """The row with the greatest length of each key, the smallest id on ties; rows of null key are all kept.

    The winner is found by an aggregate of (length, id), so that the rows themselves are not sorted by key.
    """
    kind = dict(df.dtypes)[id_col]
    measured = df.select(F.col(key).alias("_k"), length.alias("_len"), F.col(id_col).alias("_id")).where(F.col("_k").isNotNull())
    best = measured.groupBy("_k").agg(F.max("_len").alias("_best"))
    winner = measured.join(best, "_k").where(F.col("_len").eqNullSafe(F.col("_best"))).groupBy("_k").agg(F.min("_id").cast(kind).alias(id_col))
    return df.join(winner.select(id_col), id_col, "left_semi").unionByName(df.where(F.col(key).isNull()))


def keeper_ranks(df: DataFrame, group: list[str], ranks: list[Column], best: str) -> DataFrame:
    """Rows of groups of two or more with ``rank`` by the rank columns and the group's greatest ``best``."""
    w = Window.partitionBy(*group)
    return df.withColumn("members", F.count(F.lit(1)).over(w)).where("members > 1").withColumn("rank", F.row_number().over(w.orderBy(*ranks))).withColumn("group_best", F.max(best).over(w))


def provenance(df: DataFrame, key: list[str], route: str, seen_at: str) -> DataFrame:
    """One row per content: its distinct routes in order, first and last sight, and how often it came."""
    return df.groupBy(*key).agg(F.array_sort(F.collect_set(route)).alias("routes"), F.min(seen_at).alias("first_seen"), F.max(seen_at).alias("last_seen"), F.count(F.lit(1)).alias("captures"))
