"""Mixing sources to target weights: cube-method balanced sampling.

Each source gets whole copies of all its documents and a balanced sample for the fraction that is left: the cube
method moves the inclusion probabilities through the null space of the constraints (token total and document total)
until they are 0 or 1. Blocks of bounded size fly on their own and hand their few undecided documents to the next
level, until one block per source is left with at most two, which are landed.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.session import checkpointed

BLOCK = 4000
_EPS = 1e-9


def fly(p: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """The flight phase over one block: p with all but at most two entries moved to 0 or 1.

    The sums of p and of p * size stay what they are. Three undecided units at a time move along the one direction
    that both constraints allow, up or down with the probabilities that keep each unit's expectation.
    """
    p = p.astype(float).copy()
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(p))
    draws = rng.random(len(p) + 3)
    mean = float(size.mean()) if len(size) else 1.0
    s = size / (mean or 1.0)
    hand: list[int] = []
    d = 0
    for i in order.tolist():
        if p[i] <= _EPS or p[i] >= 1 - _EPS:
            p[i] = round(p[i])
            continue
        hand.append(i)
        if len(hand) < 3:
            continue
        a, b, c = hand
        u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])  # cross product of (1, 1, 1) and the sizes
        if max(map(abs, u)) < 1e-12:
            u = (1.0, -1.0, 0.0)
        up = down = math.inf
        for k, v in zip(hand, u):
            if v > 0:
                up, down = min(up, (1 - p[k]) / v), min(down, p[k] / v)
            elif v < 0:
                up, down = min(up, p[k] / -v), min(down, (1 - p[k]) / -v)
        step = up if draws[d] * (up + down) < down else -down
        d += 1
        for k, v in zip(hand, u):
            p[k] += step * v
        hand = [k for k in hand if _EPS < p[k] < 1 - _EPS]
        if len(hand) == 3:  # numerically nothing ended: end the nearest
            k = min(hand, key=lambda k: min(p[k], 1 - p[k]))
            p[k] = round(p[k])
            hand.remove(k)
    done = np.ones(len(p), bool)
    done[hand] = False
    p[done] = np.round(p[done])
    return p


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The landing phase of at most a few units: the subset whose token total is nearest to the expected one."""
    open_ = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    want = float((p[open_] * size[open_]).sum())
    best = min(range(1 << len(open_)), key=lambda m: (abs(sum(size[k] for j, k in enumerate(open_) if m >> j & 1) - want), m))
    p = p.copy()
    for j, k in enumerate(open_):
        p[k] = best >> j & 1
    return p


def _flight(seed: int, level: int, last: bool):
    """The function that flies one block, and lands it where it is the last of its source."""

    def flight(key, rows):
        rows = rows.sort_values("_id", kind="stable").reset_index(drop=True)
        p, size = rows["_p"].to_numpy(float), rows["size"].to_numpy(float)
        p = fly(p, size, zlib.crc32(f"{seed}|{level}|{key[0]}|{int(key[1])}".encode()))
        rows["_p"] = land(p, size) if last else p
        return rows[["source", "_id", "size", "_whole", "_p"]]

    return flight


def mixture_plan(totals: dict[str, tuple[int, int]], targets: list[tuple[str, float, int]], total_size: float | None = None) -> dict[str, float]:
    """Mean copies of a document of each source, so that the sources' shares of the size are the targets.

    ``totals`` has (documents, size) by source. Sources without size can't contribute: the shares of the others are
    taken in proportion. Without ``total_size`` the mixture is as large as the repeat caps allow with exact shares;
    with one, a source that would need more than its cap stays at the cap.
    """
    live = [(s, share, cap) for s, share, cap in targets if share > 0 and cap > 0 and totals.get(s, (0, 0))[1] > 0]
    whole = sum(share for _, share, _ in live)
    if not live:
        return {}
    most = min(cap * totals[s][1] / (share / whole) for s, share, cap in live)
    size = most if total_size is None else total_size
    return {s: min(float(cap), share / whole * size / totals[s][1]) for s, share, cap in live}


def mix(docs: DataFrame, id_col: str, source_col: str, size_col: str, targets: list[tuple[str, float, int]], seed: int = 7, total_size: float | None = None) -> DataFrame:
    """The selection: (source, id, size, copies >= 1).

    Documents of sources without a target, of null source, or of no size are not selected. Ids must be unique. The
    same input and seed give the same selection. Only totals of the target's sources come to the driver.
    """
    names = [s for s, _, _ in targets if s is not None]
    sized = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("_id"), F.col(size_col).cast("bigint").alias("size"))
    sized = checkpointed(sized.where(F.col("source").isin(names) & (F.col("size") > 0)))
    totals = {r["source"]: (int(r["n"]), int(r["size"])) for r in sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).collect()}
    plan = mixture_plan(totals, targets, total_size)
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    schema = f"source string, _id {kind}, size bigint, _whole int, _p double"
    if not plan:
        return spark.createDataFrame([], f"source string, {id_col} {kind}, size bigint, copies int")
    rates = [(s, math.floor(r + _EPS), max(0.0, r - math.floor(r + _EPS)), totals[s][0]) for s, r in plan.items()]
    rate = spark.createDataFrame([(s, w, p) for s, w, p, _ in rates], "source string, _whole int, _p double")
    start = sized.join(F.broadcast(rate), "source").select("source", "_id", "size", "_whole", "_p")
    decided = [start.where(f"_p <= {_EPS}")]
    open_ = start.where(f"_p > {_EPS}")
    counts = {s: n for s, _, p, n in rates if p > _EPS}

    level = 0
    while counts:
        blocks = {s: -(-n // BLOCK) for s, n in counts.items()}
        last = all(b == 1 for b in blocks.values())
        of = F.create_map(*[x for s, b in blocks.items() for x in (F.lit(s), F.lit(b))])
        placed = open_.withColumn("_block", F.pmod(F.xxhash64("_id", F.lit(seed + level)), of[F.col("source")]))

        flown = checkpointed(placed.groupBy("source", "_block").applyInPandas(_flight(seed, level, last), schema))
        decided.append(flown.where(f"_p <= {_EPS} or _p >= 1 - {_EPS}"))
        if last:
            break
        open_ = flown.where(f"_p > {_EPS} and _p < 1 - {_EPS}")
        # a block leaves two units at most, and a level has far fewer blocks than units
        counts = {s: 2 * b for s, b in blocks.items()}
        level += 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    chosen = out.withColumn("copies", F.col("_whole") + F.round("_p").cast("int")).where("copies > 0")
    return chosen.select("source", F.col("_id").alias(id_col), "size", "copies")


def shares(selection: DataFrame, targets: list[tuple[str, float, int]], docs_total: DataFrame | None = None) -> DataFrame:
    """What was reached per source of the targets, sources without a document included."""
    spark = selection.sparkSession
    want = spark.createDataFrame([(s, float(t), int(c)) for s, t, c in targets], "source string, target_share double, max_repeats int")
    got = selection.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("copies").cast("bigint").alias("copies"), F.max("copies").alias("most_repeats"), F.sum(F.col("size") * F.col("copies")).alias("tokens")
    )
    whole = got.agg(F.sum("tokens").alias("_all"))
    return (
        want.join(got, "source", "left")
        .join(F.broadcast(whole), F.lit(True), "left")
        .select(
            "source", "target_share", "max_repeats", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("documents", "copies", "most_repeats", "tokens")],
            F.coalesce(F.round(F.col("tokens") / F.col("_all"), 6), F.lit(0.0)).alias("actual_share"),
        )
    )
