"""Filling containers of fixed capacity: patterns of few documents fitted to the histogram of lengths.

All planning is done on the histogram: lengths up to the capacity with their counts, so that the work on the driver
and the plan that is broadcast depend on the capacity, not on the number of documents. Non-negative least squares
give each pattern of up to three lengths a repeat count; the counts are rounded down, and what is left over goes by
best fit into the space that remains and then into new containers. Documents find their container by their rank
among the documents of the same length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.operators.skew import salted_rank
from docketry.session import checkpointed

#: Lengths are grouped into so many bins for the patterns; the residuals are packed by exact length.
BINS = 192


def nnls(a: np.ndarray, b: np.ndarray, max_steps: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method of Lawson and Hanson on the normal equations."""
    m, n = a.shape
    gram, target = a.T @ a, a.T @ b
    x, passive = np.zeros(n), np.zeros(n, bool)
    tol = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(max_steps or 3 * m):
        w = target - gram @ x
        w[passive] = -np.inf
        j = int(np.argmax(w)) if n else 0
        if not n or w[j] <= tol:
            break
        passive[j] = True
        while True:
            at = np.flatnonzero(passive)
            s = np.linalg.lstsq(gram[np.ix_(at, at)], target[at], rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            low = at[s <= 0]
            old, new = x[low], s[s <= 0]
            step = float(np.min(old / np.maximum(old - new, 1e-300)))
            x[at] += step * (s - x[at])
            passive[at[x[at] <= 1e-12]] = False
            x[~passive] = 0
            if not passive.any():
                break
    return x


def patterns(bins: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """All patterns of one to three present bins that fill ``bins`` exactly, the last one allowed to fall short of a bin."""
    have = np.flatnonzero(present)
    known = set(have.tolist())
    out = []
    for i in have[::-1].tolist():
        if i == bins:
            out.append((i,))
        for j in have[have <= min(i, bins - i)].tolist():
            k = bins - i - j
            if k == 0:
                out.append((i, j))
            elif k <= j and k in known:
                out.append((i, j, k))
    return out


class _Plan:
    """Containers by class: ``repeats`` equal containers with ``contents`` {length: copies in each} and ``space`` left in each."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.classes, self.by_space, self.spaces = capacity, [], defaultdict(list), []

    def add(self, contents: dict[int, int], repeats: int, space: int) -> None:
        self.classes.append([repeats, contents, space])
        self._offer(len(self.classes) - 1)

    def _offer(self, c: int) -> None:
        space = self.classes[c][2]
        if space > 0:
            if not self.by_space[space]:
                insort(self.spaces, space)
            self.by_space[space].append(c)

    def place(self, length: int, n: int) -> None:
        """n documents of one length: tightest space first, new containers for the rest."""
        while n:
            at = bisect_left(self.spaces, length)
            if at == len(self.spaces):
                break
            space = self.spaces[at]
            c = self.by_space[space].pop()
            if not self.by_space[space]:
                self.spaces.pop(at)
            repeats, contents, _ = self.classes[c]
            each = min(space // length, max(1, n // repeats))
            used = min(repeats, n // each)
            if used < repeats:
                self.classes.append([repeats - used, dict(contents), space])
                self._offer(len(self.classes) - 1)
            contents = dict(contents)
            contents[length] = contents.get(length, 0) + each
            self.classes[c] = [used, contents, space - each * length]
            self._offer(c)
            n -= used * each
        each = self.capacity // length
        if n >= each:
            self.add({length: each}, n // each, self.capacity - each * length)
            n %= each
        if n:
            self.add({length: n}, 1, self.capacity - n * length)


def plan_containers(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """[(repeats, {length: copies in each})] that holds the histogram (1 <= length <= capacity) exactly."""
    left = {k: v for k, v in histogram.items() if v}
    bins = min(BINS, capacity)
    width = capacity / bins
    of = {length: max(1, int(np.ceil(length / width - 1e-9))) for length in left}
    counts = np.zeros(bins + 1)
    for length, n in left.items():
        counts[of[length]] += n
    plan = _Plan(capacity)
    # bins that hold little of the space pack well by best fit; the patterns fit the rest
    shapes = patterns(bins, counts > 0)
    if shapes:
        a = np.zeros((bins + 1, len(shapes)))
        for j, shape in enumerate(shapes):
            for i in shape:
                a[i, j] += 1
        weight = np.sqrt(np.arange(bins + 1) / bins)[:, None]  # a long document that is left over costs most
        repeats = np.floor(nnls(a * weight, counts * weight[:, 0]) + 1e-6).astype(int)
        queues = defaultdict(list)
        for length in sorted(left, reverse=True):
            queues[of[length]].append(length)
        for j in np.argsort([-max(s) for s in shapes], kind="stable"):
            todo = int(repeats[j])
            while todo:
                need: dict[int, int] = {}
                ok = True
                for i in shapes[j]:
                    while queues[i] and left[queues[i][0]] == 0:
                        queues[i].pop(0)
                    pick = next((q for q in queues[i] if left[q] > need.get(q, 0)), None)
                    if pick is None:
                        ok = False
                        break
                    need[pick] = need.get(pick, 0) + 1
                if not ok:
                    break
                times = min([todo, *(left[q] // k for q, k in need.items())])
                plan.add(dict(need), times, capacity - sum(q * k for q, k in need.items()))
                for q, k in need.items():
                    left[q] -= k * times
                todo -= times
    for length in sorted((q for q, n in left.items() if n), reverse=True):
        plan.place(length, left[length])
    return [(repeats, contents) for repeats, contents, _ in plan.classes if repeats]


def plan_rows(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, first container, copies in each) ordered by length and rank; ranks count per length from 0."""
    next_rank: dict[int, int] = defaultdict(int)
    out, base = [], 0
    for repeats, contents in plan:
        for length, each in contents.items():
            out.append((length, next_rank[length], base, each))
            next_rank[length] += repeats * each
        base += repeats
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 4)


def pack(items: DataFrame, id_col: str, size_col: str, containers: list[tuple[str, int]]) -> DataFrame:
    """Every item in a container of each capacity: (container_name, container_id, item id, piece_no, size).

    An item larger than the capacity is cut into full pieces, which fill a container each, and one remainder that is
    packed like any other item; no other item is cut. Items of size 0 or null take no space and do not come out.
    ``piece_no`` counts from 0. Ids must be unique; equal sizes are ordered by their hash bucket and id, so the result
    is the same on every run. Container names and positive capacities come from a table of fixed size.
    """
    spark = items.sparkSession
    caps = [(n, int(c)) for n, c in containers if n is not None and c is not None and c > 0]
    sized = checkpointed(items.select(F.col(id_col).alias("_id"), F.col(size_col).cast("bigint").alias("_size")).where("_size > 0"))
    specs = F.explode(F.array(*[F.struct(F.lit(n).alias("container_name"), F.lit(c).cast("bigint").alias("_cap")) for n, c in caps]))
    pieces = sized.withColumn("_c", specs).select("_id", "_size", "_c.*").withColumn("_full", F.floor((F.col("_size")) / F.col("_cap")))
    full = pieces.where("_full > 0").select(
        "container_name", F.col("_id"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_full") - 1)).alias("piece_no"), F.col("_cap").alias("size")
    )
    full = full.select("container_name", F.concat_ws("-", F.lit("full"), "_id", "piece_no").alias("container_id"), "_id", F.col("piece_no").cast("int"), "size")
    rest = pieces.withColumn("size", F.col("_size") - F.col("_full") * F.col("_cap")).where("size > 0").select("container_name", "_id", F.col("_full").cast("int").alias("piece_no"), "size")
    # at most capacity rows per container come to the driver
    histogram = defaultdict(dict)
    for name, size, n in rest.groupBy("container_name", "size").agg(F.count(F.lit(1))).collect():
        histogram[name][int(size)] = int(n)
    plans = {name: plan_rows(plan_containers(histogram[name], cap)) for name, cap in caps if histogram[name]}
    shared = spark.sparkContext.broadcast(plans)
    ranked = salted_rank(rest, ["container_name", "size"], "_id")

    def assign(batches):
        for batch in batches:
            ids = np.empty(len(batch), dtype=np.int64)
            for name, at in batch.groupby("container_name").indices.items():
                rows = shared.value[name]
                span = int(rows[:, 1].max()) + 1 + int(batch["rank"].max()) + 1
                size, rank = batch["size"].to_numpy()[at], batch["rank"].to_numpy()[at]
                k = np.searchsorted(rows[:, 0] * span + rows[:, 1], size * span + rank, side="right") - 1
                ids[at] = rows[k, 2] + (rank - rows[k, 1]) // rows[k, 3]
            yield pd.DataFrame({"container_name": batch["container_name"], "container_id": [f"pack-{i}" for i in ids], "_id": batch["_id"], "piece_no": batch["piece_no"], "size": batch["size"]})

    kind = dict(items.dtypes)[id_col]
    packed = ranked.select("container_name", "_id", "piece_no", "size", "rank").mapInPandas(assign, f"container_name string, container_id string, _id {kind}, piece_no int, size bigint")
    return full.unionByName(packed).withColumnRenamed("_id", id_col)
