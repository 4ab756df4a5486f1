"""Identity of records in two states: exact links, and reviews where the evidence disagrees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_identity(probe: DataFrame, build: DataFrame, key: list[str]) -> DataFrame:
    """(probe_id, build_id, outcome) for rows (id, text_hash, key...) of two states.

    Rows of the same key and the same text hash are linked if the match is the only one, and 'ambiguous' (with no
    build_id) if there are several; a peer of the same key and another hash is 'same_identity_different_text', and the
    same hash under another key 'hash_mismatch'. A null in the key or hash matches nothing. The pairs come from two
    equi-joins, each on a key that is as selective as an identity.
    """
    p = probe.select(F.col("id").alias("probe_id"), F.col("text_hash").alias("ph"), *[F.col(k).alias(f"p_{k}") for k in key])
    b = build.select(F.col("id").alias("build_id"), F.col("text_hash").alias("bh"), *[F.col(k).alias(f"b_{k}") for k in key])
    same_key = [F.col(f"p_{k}") == F.col(f"b_{k}") for k in key]
    peers = p.join(b, same_key).select("probe_id", "build_id", (F.col("ph") == F.col("bh")).alias("same"))
    exact = peers.where("same").groupBy("probe_id").agg(F.count(F.lit(1)).alias("n"), F.min("build_id").alias("build_id"))
    linked = exact.select("probe_id", F.when(F.col("n") == 1, F.col("build_id")).alias("build_id"), F.when(F.col("n") == 1, "linked").otherwise("ambiguous").alias("outcome"))
    several = exact.where("n > 1").select("probe_id")
    different = peers.where(~F.col("same")).join(several, "probe_id", "left_anti").select("probe_id", "build_id", F.lit("same_identity_different_text").alias("outcome"))
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(f"p_{k}").isNotNull()
    all_same = F.lit(True)
    for c in same_key:
        all_same = all_same & F.coalesce(c, F.lit(False))
    stray = p.where(whole).join(b, F.col("ph") == F.col("bh")).where(~all_same).select("probe_id", "build_id", F.lit("hash_mismatch").alias("outcome")).join(several, "probe_id", "left_anti")
    return linked.unionByName(different).unionByName(stray)


def resolve_unique(refs: DataFrame, ref_key: str, targets: DataFrame, target_keys: list[str], target_id: str) -> DataFrame:
    """References with ``resolved_id`` and ``resolution``: linked for one target under any of its keys, ambiguous for more, else unresolved."""
    keyed = None
    for k in target_keys:
        one = targets.select(F.col(k).alias(ref_key), F.col(target_id).alias("_t")).where(F.col(ref_key).isNotNull())
        keyed = one if keyed is None else keyed.unionByName(one)
    hits = keyed.groupBy(ref_key).agg(F.min("_t").alias("_low"), F.max("_t").alias("_high"))
    out = refs.join(hits, ref_key, "left")
    return out.select(
        *refs.columns,
        F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("resolved_id"),
        F.when(F.col("_low").isNull(), "unresolved").when(F.col("_low") == F.col("_high"), "linked").otherwise("ambiguous").alias("resolution"),
    )
