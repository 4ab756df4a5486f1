"""Joins and ranks that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key is hot from this share of the rows on. At most 1 / HOT_SHARE keys can be hot, which bounds what is broadcast.
HOT_SHARE = 0.002
#: Rows of a hot key to one salt, and the most salts of a key, which bounds how often the other side is repeated.
ROWS_PER_SALT, MOST_SALTS = 100_000, 1024


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, counts: DataFrame | None = None, floor: int = 20_000) -> DataFrame:
    """(_hot, _salts): keys with at least ``share`` of all rows and at least ``floor`` rows, never more than ``1 / share`` of them, with the salts of each.

    ``counts`` (key, n) may be passed where it exists already. Null keys are no keys.
    """
    n = counts if counts is not None else df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("_total"))
    return (
        n.where(F.col("n") >= floor)
        .join(F.broadcast(total), F.col("n") >= F.col("_total") * F.lit(share))
        .select(F.col(key).alias("_hot"), F.least(F.lit(MOST_SALTS), F.greatest(F.lit(2), F.ceil(F.col("n") / ROWS_PER_SALT))).cast("bigint").alias("_salts"))
    )


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", salt_by: Column | None = None, hot: DataFrame | None = None) -> DataFrame:
    """``left`` joined to ``right`` on ``key`` where single keys of ``left`` may be hot.

    Hot keys of the left side are spread, by ``salt_by`` (a hash of the row's id), over as many parts as their rows ask for and the
    matching rows of the right side are repeated for each part; all other keys join as they are. ``how`` is
    inner, left, left_semi or left_anti. The right side must not be hot on the key.
    """
    hot = hot_keys(left, key) if hot is None else hot
    salt_by = F.monotonically_increasing_id() if salt_by is None else salt_by
    zero = F.lit(0).cast("bigint")
    marked = left.join(F.broadcast(hot), left[key] == hot["_hot"], "left").withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(salt_by), F.col("_salts"))).otherwise(zero)).drop("_hot", "_salts")
    spread = (
        right.join(F.broadcast(hot), right[key] == hot["_hot"], "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(zero, F.col("_salts") - 1)).otherwise(F.array(zero))))
        .drop("_hot", "_salts")
    )
    return marked.join(spread, [key, "_salt"], how).drop("_salt")


def salted_rank(df: DataFrame, group: list[str], order_id: str, out: str = "rank", buckets: int = 256) -> DataFrame:
    """A dense 0-based rank of the rows of each group, without sorting a whole group in one task.

    Rows are split into ``buckets`` by a hash of ``order_id``; each (group, bucket) is numbered by its own window
    and offset by the counts of the buckets before it. The window over the counts has at most ``buckets`` rows.
    """
    b = df.withColumn("_b", F.pmod(F.xxhash64(F.col(order_id)), F.lit(buckets)))
    sizes = b.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inner = Window.partitionBy(*group, "_b").orderBy(order_id)
    numbered = b.withColumn("_r", F.row_number().over(inner) - 1)
    return numbered.join(offsets, [*group, "_b"]).withColumn(out, F.col("_r") + F.col("_off")).drop("_r", "_off", "_b")
