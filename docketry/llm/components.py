"""Consolidating pairwise matches into groups: connected components over any number of pairs.

Minimum labels are propagated across the edges and accelerated by pointer jumping; every round ends in a
checkpoint in the shared folder, and the rounds end when no label changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.skew import hot_keys, skew_join
from docketry.session import checkpointed


def star_edges(members: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """Edges (src, dst) that connect all ids of a key: each id with the key's smallest, never pair by pair.

    ``members`` holds (id, key) rows; rows with a null in either are no membership. The smallest id is aggregated
    before it is joined back, and hot keys are salted on that way.
    """
    rows = members.select(F.col(id_col).alias("_id"), F.col(key_col).alias("_key")).where(F.col("_id").isNotNull() & F.col("_key").isNotNull())
    hubs = rows.groupBy("_key").agg(F.min("_id").alias("_hub"), F.count(F.lit(1)).alias("n"))
    hot = hot_keys(rows, "_key", counts=hubs.select("_key", "n"))
    shared = hubs.where("n > 1").select("_key", "_hub")
    joined = skew_join(rows, shared, "_key", "inner", salt_by=F.col("_id"), hot=hot)
    return joined.where("_id <> _hub").select(F.col("_id").alias("src"), F.col("_hub").alias("dst"))


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(id, group_id) for every id in an edge (src, dst) of two different ids; group_id is the smallest id of its component.

    Ids are of one ordered type. Null ends and self-links are ignored, repeated and reversed edges count once, and no
    edges give no rows. A round takes for each id the smallest label among its neighbours, hands it to the id's
    former label as well (so that whole trees are hooked together, not single ids), and then replaces each label by
    the label's own label. Hubs and labels of a large component are salted in the joins.
    """
    sound = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    both = checkpointed(sound.select("src", "dst").union(sound.select("dst", "src")).distinct())
    labels = checkpointed(both.groupBy("src").agg(F.min(F.least("src", "dst")).alias("label")).withColumnRenamed("src", "id"))
    hubs = _known_hot(both, "dst")
    before = None
    for _ in range(max_rounds):
        near = _join(both, labels.withColumnRenamed("id", "dst"), "dst", F.col("src"), hubs).select(F.col("src").alias("id"), "label", F.lit(None).cast(labels.schema["label"].dataType).alias("own"))
        own = labels.select("id", "label", F.col("label").alias("own"))
        seen = near.unionByName(own).groupBy("id").agg(F.min("label").alias("label"), F.min("own").alias("own"))
        hooked = seen.select(F.explode(F.array(F.struct("id", "label"), F.struct(F.col("own").alias("id"), "label"))).alias("x")).select("x.*").groupBy("id").agg(F.min("label").alias("label"))
        hooked = checkpointed(hooked)
        roots = _known_hot(hooked, "label")
        jumped = _join(hooked, hooked.select(F.col("id").alias("label"), F.col("label").alias("_next")), "label", F.col("id"), roots)
        labels = checkpointed(jumped.select("id", F.least("label", "_next").alias("label")))
        now = labels.agg(F.sum(F.xxhash64("id", "label").cast("decimal(38,0)")), F.count(F.lit(1))).first()
        if now == before:
            return labels.withColumnRenamed("label", "group_id")
        before = now
    raise RuntimeError(f"labels still change after {max_rounds} rounds")


def _known_hot(df: DataFrame, key: str) -> list:
    """Hot keys on the driver; hot_keys bounds their number."""
    return [r[0] for r in hot_keys(df, key).collect()]


def _join(left: DataFrame, right: DataFrame, key: str, salt_by: Column, hot: list) -> DataFrame:
    if not hot:
        return left.join(right, key)
    spark = left.sparkSession
    keys = spark.createDataFrame([(k,) for k in hot], left.select(F.col(key).alias("_hot")).schema)
    return skew_join(left, right, key, "inner", salt_by, keys)
