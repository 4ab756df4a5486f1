import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from docketry.operators.dedupe import exact_duplicates, longest_wins, provenance
from docketry.operators.identity import reconcile_identity, resolve_unique
from docketry.operators.sections import carry_forward_merge, fuller_text_wins, is_fake_number, missing_in_run, reextract_gate, split_sections
from docketry.operators.staging import confidence, outcomes, reconcile
from docketry.operators.timelines import gaps, nearest_before, number_gaps, streak_summary, streaks
from docketry.operators.vectors import cosine_topk
from docketry.operators.visibility import quarantined, servable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_visibility(spark):
    a = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    m = spark.createDataFrame([("b",), ("b",), (None,)], "rid string")
    assert rows(servable(a, "id", m, "rid")) == [("a",), (None,)]
    assert rows(quarantined(a, "id", m, "rid")) == [("b",)]
    assert rows(servable(a, "id", m.limit(0), "rid")) == rows(a)


def test_dedupe(spark):
    d = spark.createDataFrame([(1, "k", "xx"), (2, "k", "yyy"), (3, "k", "zzz"), (4, None, "a"), (5, None, "b"), (6, "q", None)], "id int, k string, t string")
    assert rows(longest_wins(d, "k", F.length("t"), "id").select("id")) == [(2,), (4,), (5,), (6,)]
    assert rows(exact_duplicates(d, "id", F.col("k"))) == [("k", 3, 1)]
    assert exact_duplicates(d.limit(0), "id", F.col("k")).count() == 0
    p = provenance(d.withColumn("at", F.col("id")), ["k"], "t", "at").where("k = 'k'").first()
    assert p["routes"] == ["xx", "yyy", "zzz"] and p["captures"] == 3


def test_identity_truth_table(spark):
    schema = "id string, text_hash string, court string, day string"
    probe = spark.createDataFrame([("u1", "h1", "c", "d"), ("u2", "h2", "c", "d"), ("u3", "h3", "x", "d"), ("u4", "h9", "c", None), ("u5", "hh", "m", "d"), ("u6", None, "c", "d")], schema)
    build = spark.createDataFrame([("r1", "h1", "c", "d"), ("r3", "h3", "y", "d"), ("r5a", "hh", "m", "d"), ("r5b", "hh", "m", "d"), ("r9", "h9", "c", None)], schema)
    got = rows(reconcile_identity(probe, build, ["court", "day"]))
    assert got == [
        ("u1", "r1", "linked"),
        ("u2", "r1", "same_identity_different_text"),
        ("u3", "r3", "hash_mismatch"),
        ("u5", None, "ambiguous"),
    ]


def test_resolve_unique(spark):
    refs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "i int, k string")
    targets = spark.createDataFrame([("t1", "a", "z"), ("t2", "b", None), ("t3", "q", "b"), ("t1", "a", "a")], "id string, k1 string, k2 string")
    assert rows(resolve_unique(refs, "k", targets, ["k1", "k2"], "id")) == [(1, "a", "t1", "linked"), (2, "b", None, "ambiguous"), (3, "c", None, "unresolved"), (4, None, None, "unresolved")]


def test_section_numbers(spark):
    df = spark.createDataFrame([([1, 2, 4, 1947, 9000, None],), ([],), ([None],)], "n array<int>")
    assert [r[0] for r in df.select(missing_in_run(F.col("n"), F.lit(5))).collect()] == [2, 10_000, 10_000]
    one = spark.createDataFrame([(x, [1, 2, 3, 4, x]) for x in (5, 1947, 6000, 250, 99)], "x int, n array<int>")
    assert [r[0] for r in one.select(is_fake_number(F.col("x"), F.col("n"))).collect()] == [False, True, True, True, False]


def test_sections(spark):
    d = spark.createDataFrame([(1, "Preamble\n1. First.\nmore\n2-A. Second\n1. First at greater length."), (2, "no heading"), (3, ""), (4, None)], "id int, t string")
    s = split_sections(d, "id", "t")
    assert rows(s)[:2] == [(1, 0, None, "Preamble"), (1, 1, "1", "First.\nmore")]
    assert rows(fuller_text_wins(s, "id", "section_number", "section_text", "ordinal")) == [(1, "1", "First at greater length."), (1, "2-A", "Second")]
    m = spark.createDataFrame([(1, 1, True, "lost"), (1, 2, False, "a"), (1, 3, True, "b"), (1, 4, True, " "), (1, 5, False, None)], "d int, o int, bogus boolean, t string")
    assert rows(carry_forward_merge(m.drop("x"), "d", "o", F.col("bogus"), "t").select("o", "t", "merged")) == [(2, "a\nb", 1), (5, "", 0)]
    before = spark.createDataFrame([("x", str(i), "t") for i in range(1, 9)] + [("y", "1", "t"), ("y", "2", "t")], "d string, n string, t string")
    after = spark.createDataFrame([("x", "1", "t"), ("y", "2", "t"), ("z", "1", "t")], "d string, n string, t string")
    assert rows(reextract_gate(before, after, "d", "n", "t")) == [("x", 1, 7, "lost_half"), ("y", 1, 1, "lost_first"), ("z", 0, 0, "pass")]


def test_timelines(spark):
    e = spark.createDataFrame([("a", i, m) for i, m in enumerate([True, True, False, True, None, True, True, True])], "k string, o int, m boolean")
    assert rows(streaks(e, ["k"], ["o"], F.col("m"))) == [("a", 1, 2), ("a", 2, 1), ("a", 3, 3)]
    for width in (1, 2, 3, 5, 100):  # the summary is the same however the rows are cut
        long = e.unionByName(spark.createDataFrame([("b", i, True) for i in range(7)] + [("c", 1, False)], e.schema))
        assert rows(streak_summary(long, ["k"], F.floor(F.col("o") / width), ["o"], F.col("m"))) == [("a", 3, 3), ("b", 1, 7)]
        g = spark.createDataFrame([("a", n) for n in (1, 2, 3, 7, 8, 9, 20)] + [("b", 5), ("b", None)], "k string, n int")
        assert {tuple(r) for r in number_gaps(g, "k", "n", width).collect()} == {("a", 3, 7), ("a", 9, 20), ("a", 20, None), ("b", 5, None)}
    assert rows(gaps(e.where("o in (0, 1, 5, 7)"), ["k"], "o", 2)) == [("a", 1, 5)]
    left = spark.createDataFrame([("a", 5, 1), ("a", 2, 2), ("b", 9, 3)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 4, 40), ("a", 5, 50)], "k string, t int, v int")
    assert rows(nearest_before(left, right, "k", "t", "v", "id")) == [("a", 2, 2, None), ("a", 5, 1, 40), ("b", 9, 3, None)]


def test_staging(spark):
    d = spark.createDataFrame([(1, "a", None, "the A text", 0.9), (2, None, "b", "has B in it", 0.9), (3, None, "c", "nothing", 0.9), (4, None, None, None, 0.9)], "i int, x string, y string, t string, c double")
    v, conflict = reconcile(F.col("x"), F.col("y"), F.col("t"))
    assert rows(d.select("i", v, conflict, confidence(F.col("c"), conflict.cast("int"), F.lit(1), F.lit(True)))) == [(1, "a", False, 0.85), (2, "b", False, 0.85), (3, None, True, 0.75), (4, None, False, 0.85)]
    o = spark.createDataFrame([(1, "k", "t"), (2, "k", "t"), (3, None, "t"), (4, None, "t"), (5, "k", None)], "i int, k string, t string")
    assert rows(outcomes(o, ["k"], ["i"], [("no text", F.col("t").isNull())]).select("i", "outcome", "reason")) == [(1, "promoted", None), (2, "duplicate", "same identity"), (3, "promoted", None), (4, "promoted", None), (5, "quarantined", "no text")]


def test_cosine_against_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((60, 8)).round(3)
    v[7] = v[8]  # a tie
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(99, None)], "id int, e array<double>")
    got = {}
    for r in cosine_topk(df.where("id % 10 = 0"), df, "id", "e", 3).collect():
        got.setdefault(r["qid"], []).append((r["sim"], r["id"]))
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = np.round(n @ n.T, 6)
    for q in range(0, 60, 10):
        want = sorted((-sims[q, i], i) for i in range(60) if i != q)[:3]
        assert sorted((-s, i) for s, i in got[q]) == want
    assert cosine_topk(df.limit(0), df, "id", "e", 3).count() == 0


def test_citation_keys_of_all_reporters(spark, tmp_path):
    import re

    from docketry.plans.catalog import CORE

    cites = ["PLD 2001 SC 12", "PLD 1999 Lahore 7", "2004 SCMR 88", "2010 PCrLJ 009", "2011 CLC 3", "2012 CLD 4", "1998 MLD 5", "1997 PLC 6", "2003 PLJ 7", "2005 PTCL 8", "2006 PTD 9", "2007 YLR 10", "no citation", None]
    spark.createDataFrame([(f"j{i}", c) for i, c in enumerate(cites)], "id string, canonical_citation string").write.parquet(f"{tmp_path}/judgment.parquet")

    def key(cite):
        m = re.fullmatch(r"PLD (\d{4}) (\w+) (\d+)", cite or "")
        if m:
            return f"PLD:{m[1]}:{m[2].upper()}:{int(m[3])}"
        m = re.fullmatch(r"(\d{4}) (\w+) (\d+)", cite or "")
        return f"{m[2].upper()}:{m[1]}::{int(m[3])}" if m else None

    got = {r["id"]: r["k"] for r in CORE.queries["citation_keys"](spark, str(tmp_path)).collect()}
    assert got == {f"j{i}": key(c) for i, c in enumerate(cites)}


def test_marks_and_their_undoing(spark):
    from docketry.operators.quarantine import apply_marks, undo_marks

    records = spark.createDataFrame([(1, "open"), (2, None), (3, "quarantined"), (4, "open"), (None, "open")], "id int, state string")
    marks = spark.createDataFrame([(1,), (1,), (2,), (3,), (9,), (None,)], "id int")
    after, before = apply_marks(records, "id", marks, "state", "quarantined")
    assert {tuple(r) for r in after.collect()} == {(1, "quarantined"), (2, "quarantined"), (3, "quarantined"), (4, "open"), (None, "open")}
    assert {tuple(r) for r in before.collect()} == {(1, "open"), (2, None)}
    assert {tuple(r) for r in undo_marks(after, "id", before, "state").collect()} == {tuple(r) for r in records.collect()}
    none, noted = apply_marks(records.limit(0), "id", marks, "state", "quarantined")
    assert none.count() == 0 and noted.count() == 0
