import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from docketry.llm.mixing import fly, land, mix, mixture_plan, shares
from docketry.llm.packing import nnls, pack, plan_containers, plan_rows
from docketry.llm.tokens import encoder, token_count


def test_nnls_meets_the_optimality_conditions():
    rng = np.random.default_rng(1)
    a, b = rng.random((12, 30)), rng.random(12)
    x = nnls(a, b)
    gradient = a.T @ (a @ x - b)
    assert (x >= 0).all() and (gradient > -1e-6).all() and abs((gradient * x).sum()) < 1e-6


def first_fit_decreasing(sizes, capacity):
    left = []
    for size in sorted(sizes.elements(), reverse=True):
        for i, space in enumerate(left):
            if space >= size:
                left[i] -= size
                break
        else:
            left.append(capacity - size)
    return len(left)


def test_plan_holds_the_histogram_exactly():
    rng = random.Random(2)
    for capacity in (1, 7, 64, 512):
        sizes = Counter(min(capacity, int(rng.paretovariate(1.1) * 3)) for _ in range(3000))
        plan = plan_containers(dict(sizes), capacity)
        held = Counter()
        for repeats, contents in plan:
            assert sum(k * v for k, v in contents.items()) <= capacity
            for k, v in contents.items():
                held[k] += repeats * v
        assert held == sizes
        assert sum(r for r, _ in plan) <= 1.01 * first_fit_decreasing(sizes, capacity) + 1
    assert plan_containers({}, 10) == [] and plan_rows([]).shape == (0, 4)


def test_pack(spark):
    rng = random.Random(4)
    items = [(i, rng.choice([0, None, 3, 5, 10, 25, 31, 64, 65, 130])) for i in range(500)]
    got = pack(spark.createDataFrame(items, "id bigint, n bigint"), "id", "n", [("a", 32), ("b", 64), ("none", None)]).collect()
    for name, capacity in (("a", 32), ("b", 64)):
        mine = [r for r in got if r["container_name"] == name]
        fill, whole, pieces = Counter(), Counter(), defaultdict(list)
        for r in mine:
            fill[r["container_id"]] += r["size"]
            whole[r["id"]] += r["size"]
            pieces[r["id"]].append(r["piece_no"])
        assert max(fill.values()) <= capacity
        assert whole == Counter({i: n for i, n in items if n})
        for i, n in items:
            if n:
                assert sorted(pieces[i]) == list(range(-(-n // capacity)))
    assert pack(spark.createDataFrame([], "id bigint, n bigint"), "id", "n", [("a", 32)]).count() == 0


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 900, 3000).astype(float)
    p = np.full(3000, 0.37)
    q = fly(p, size, 11)
    assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 2
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * size).sum() - (p * size).sum()) < 1e-3
    r = land(q, size)
    assert set(r) <= {0.0, 1.0} and abs((r * size).sum() - (p * size).sum()) < 900
    same = fly(np.full(50, 0.5), np.full(50, 7.0), 1)  # equal sizes: ties
    assert abs(same.sum() - 25) < 1e-9
    assert fly(np.array([]), np.array([]), 1).size == 0


def test_plan_respects_caps():
    plan = mixture_plan({"a": (10, 100), "b": (5, 1000)}, [("a", 0.5, 2), ("b", 0.3, 1), ("none", 0.2, 4)])
    assert plan["a"] <= 2 and plan["b"] <= 1
    assert abs(plan["a"] * 100 / (plan["a"] * 100 + plan["b"] * 1000) - 0.625) < 1e-9
    assert mixture_plan({}, [("a", 1.0, 1)]) == {}


def test_mix(spark):
    rng = random.Random(6)
    docs = [(i, rng.choice(["big"] * 8 + ["small", None, "other"]), rng.choice([0, None, 1, 7, 30, 200])) for i in range(12000)]
    targets = [("big", 0.6, 1), ("small", 0.3, 3), ("missing", 0.1, 4)]
    df = spark.createDataFrame(docs, "id bigint, source string, n bigint")
    got = mix(df, "id", "source", "n", targets)
    rows = got.collect()
    assert len({r["id"] for r in rows}) == len(rows)
    tokens = Counter()
    for r in rows:
        tokens[r["source"]] += r["size"] * r["copies"]
        assert 1 <= r["copies"] <= {"big": 1, "small": 3}[r["source"]]
    whole = sum(tokens.values())
    assert abs(tokens["big"] / whole - 2 / 3) < 0.002 and abs(tokens["small"] / whole - 1 / 3) < 0.002
    report = {r["source"]: r for r in shares(got, targets).collect()}
    assert report["missing"]["tokens"] == 0 and report["missing"]["actual_share"] == 0
    assert sorted(map(tuple, mix(df, "id", "source", "n", targets).collect())) == sorted(map(tuple, rows))
    assert mix(df.limit(0), "id", "source", "n", targets).count() == 0


def test_tokens_round_trip(spark):
    texts = ["The Court held, per curiam: Rs. 5,000.", "", None, "عدالت نے قرار دیا", "x" * 5000]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(token_count(F.col("t"))).collect()]
    e = encoder()
    assert got == [len(e.encode_ordinary(t or "")) for t in texts]
    assert all(e.decode(e.encode_ordinary(t or "")) == (t or "") for t in texts)
