import random
from collections import defaultdict

from pyspark.sql import functions as F

from docketry.functions.citations import citation_key
from docketry.llm.components import connected_components, star_edges


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)]  # a long chain
    edges += [(1000, 1000 + i) for i in range(1, 80)]  # a hub
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    edges += [(5, 5), (None, 7), (7, None), (1, 0), (1, 0)]
    got = {r["id"]: r["group_id"] for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == union_find(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0
    assert connected_components(spark.createDataFrame([(1, 1)], "src bigint, dst bigint")).count() == 0


def test_star_edges_link_all_members_of_a_key(spark):
    rows = [(1, "a"), (2, "a"), (3, "a"), (3, "b"), (9, "b"), (4, None), (None, "a"), (5, "alone"), (2, "a")]
    edges = [tuple(r) for r in star_edges(spark.createDataFrame(rows, "id bigint, key string"), "id", "key").collect()]
    groups = defaultdict(set)
    for x, g in union_find(edges).items():
        groups[g].add(x)
    assert dict(groups) == {1: {1, 2, 3, 9}}


def test_citation_keys(spark):
    same = [
        ["(P L D 1975 Isl. 369)", "PLD 1975 Islamabad 369", "pld 1975 isb, p. 369.", "P.L.D.-1975-ISLAMABAD-0369", " PLD 1975 Islamabad page 369 "],
        ["2017 C L D page 162", "2017-CLD-162", "CLD 2017 162", "(2017 cld 162)"],
        ["PLD 1986 Federal Shariat Court, p. 3337", "PLD 1986 F.S.C. 3337"],
        ["PLD 1974 S C 1223", "PLD 1974 SUPREME COURT 1223."],
        ["1995 PCrLJ page 1837", "1995 P Cr. L J 1837"],
        ["2018 PCrLJ 1837"],
        ["PLD 1974 Lahore 1223"],
    ]
    none = ["Unreported", "-", "", None, "N.A.", "W.P. No. 12 of 1999", "2017 CLD", "17 CLD 162", "2001 CLD 5 6"]
    rows = [(i, x) for i, xs in enumerate(same) for x in xs] + [(-1, x) for x in none]
    got = spark.createDataFrame(rows, "g int, x string").select("g", "x", citation_key(F.col("x")).alias("k")).collect()
    keys = defaultdict(set)
    for r in got:
        keys[r["g"]].add(r["k"])
    assert keys.pop(-1) == {None}
    assert all(len(v) == 1 and None not in v for v in keys.values()), keys
    assert len(set.union(*keys.values())) == len(same)
