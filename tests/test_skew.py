from collections import Counter

from pyspark.sql import functions as F

from docketry.operators.skew import hot_keys, salted_rank, skew_join


def test_skew_join_is_a_join(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 7}" if i % 5 else None) for i in range(300)], "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    hot = hot_keys(left, "k", 0.3, floor=10)
    assert [r[0] for r in hot.collect()] == ["hot"]
    for how in ("inner", "left", "left_anti", "left_semi"):
        cols = ["i", "k"] + (["v"] if how in ("inner", "left") else [])
        want = Counter(map(tuple, left.join(right, "k", how).select(cols).collect()))
        assert Counter(map(tuple, skew_join(left, right, "k", how, F.col("i"), hot).select(cols).collect())) == want


def test_salted_rank_is_dense(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(101)], "i int, g int")
    got = salted_rank(df, ["g"], "i", buckets=7).collect()
    for g in (0, 1):
        assert sorted(r["rank"] for r in got if r["g"] == g) == list(range(sum(r["g"] == g for r in got)))
