import datetime as dt

from pyspark.sql import functions as F

from docketry.operators.history import text_key, version_history
from docketry.operators.references import orphan_references

SCHEMA = "section_id string, effective_from date, created_at timestamp_ntz, id string, section_text string, version_no int"


def history(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = version_history(df, ["section_id"], "effective_from", "created_at", "id", text_key(F.col("section_text"))).orderBy("section_id", "version_no").collect()
    return [tuple(r) for r in got]


def d(day, month=1):
    return dt.date(2020, month, day)


def t(day):
    return dt.datetime(2021, 1, day)


def test_versions(spark):
    rows = [
        ("a", d(1), t(1), "1", "old text", 9),
        ("a", d(1), t(2), "2", "new text", 9),  # a correction of the same day
        ("a", d(5), t(1), "3", "new  text\n", 9),  # only white space differs
        ("a", d(9), t(1), "4", "other", 9),
        ("a", d(12), t(1), "5", "new text", 9),  # back to an earlier text: a version of its own
        ("a", None, t(9), "6", "no date", 9),
        (None, d(1), t(1), "7", "no key", 9),
        ("b", d(2), None, "8", None, 9),
        ("b", d(3), t(1), "9", None, 9),
        ("b", d(4), t(1), "10", "", 9),  # empty is not null
    ]
    assert history(spark, rows) == [
        ("a", 1, d(1), d(8)),
        ("a", 2, d(9), d(11)),
        ("a", 3, d(12), None),
        ("b", 1, d(2), d(3)),
        ("b", 2, d(4), None),
    ]


def test_history_ties_repeats_and_empty(spark):
    row = ("a", d(1), t(1), "1", "x", 1)
    assert history(spark, [row, row, ("a", d(1), t(1), "2", "y", 1)]) == [("a", 1, d(1), None)]
    assert history(spark, []) == []


def test_orphans(spark):
    refs = spark.createDataFrame(
        [("r1", " ABC ", t(5)), ("r2", "abc", t(1)), ("r3", "gone", t(1)), ("r4", "nope", t(1)), ("r5", None, t(1)), ("r6", "  ", t(1)), ("r7", "0000-0000", t(1)), ("r8", "back", t(1)), ("r9", "nope", None)],
        "rid string, fk string, ts timestamp_ntz",
    )
    parents = spark.createDataFrame([("Abc", t(3)), ("back", t(1)), (None, t(1))], "id string, created_at timestamp_ntz")
    gone = spark.createDataFrame([("GONE",), ("back",), (None,)], "record_id string")
    got = orphan_references(refs, F.col("rid"), F.col("fk"), F.col("ts"), parents, F.col("id"), F.col("created_at"), gone)
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("r2", "2021-01", "late"),
        ("r3", "2021-01", "deleted"),
        ("r4", "2021-01", "missing"),
        ("r9", None, "missing"),
    ]
    assert orphan_references(refs.limit(0), F.col("rid"), F.col("fk"), F.col("ts"), parents, F.col("id"), F.col("created_at"), gone).count() == 0
