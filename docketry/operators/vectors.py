"""Vectors: exact nearest neighbours by cosine and means by label."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of the query vectors that are broadcast at a time, and queries that are multiplied at a time.
BROADCAST_BYTES, BLOCK = 64 << 20, 1024


def cosine_topk(queries: DataFrame, rows: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """(qid, id, sim) of the k nearest other rows of every query, exactly.

    The stated query set is broadcast in parts of a fixed size in bytes, each of which is one more pass over the rows;
    a row batch meets a part block by block as matrix products and hands on its k best per query, so that what is
    shuffled is k rows per query and batch. Ties go to the smaller id; null vectors and zero vectors match nothing.
    """
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[id_col]
    wanted = queries.where(F.col(vec_col).isNotNull()).select(id_col, vec_col)
    n, width = wanted.agg(F.count(F.lit(1)), F.max(F.size(vec_col))).first()
    parts = max(1, -(-n * (width or 1) * 8 // BROADCAST_BYTES))
    out = None
    for at in range(parts):
        block = wanted.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(parts)) == at).collect()
        if not block:
            continue
        q = np.array([r[1] for r in block], dtype=np.float64)
        shared = spark.sparkContext.broadcast((np.array([r[0] for r in block]), q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)))

        def best(batches, shared=shared):
            for batch in batches:
                batch = batch[batch[vec_col].notna()]
                if not len(batch):
                    continue
                v = np.stack(batch[vec_col].to_numpy()).astype(np.float64)
                v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                own = batch[id_col].to_numpy()
                for b in range(0, len(shared.value[0]), BLOCK):
                    names, q = shared.value[0][b : b + BLOCK], shared.value[1][b : b + BLOCK]
                    sims = np.round(q @ v.T, 6)
                    sims[names[:, None] == own[None, :]] = -np.inf
                    order = np.lexsort((np.broadcast_to(own, sims.shape), -sims), axis=1)[:, :k]
                    yield pd.DataFrame({"qid": np.repeat(names, order.shape[1]), id_col: own[order].ravel(), "sim": np.take_along_axis(sims, order, axis=1).ravel()}).query("sim > -inf")

        part = rows.select(id_col, vec_col).mapInPandas(best, f"qid {kind}, {id_col} {kind}, sim double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"qid {kind}, {id_col} {kind}, sim double")
    w = Window.partitionBy("qid").orderBy(F.desc("sim"), id_col)
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def label_centroids(rows: DataFrame, label: str, vec_col: str) -> DataFrame:
    """(label, i, mean) of each dimension, from 1."""
    e = rows.select(label, F.posexplode(vec_col).alias("i", "x"))
    return e.groupBy(label, (F.col("i") + 1).cast("bigint").alias("i")).agg(F.round(F.avg("x"), 6).alias("mean"))
