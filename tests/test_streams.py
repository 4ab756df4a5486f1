import datetime as dt
import uuid

from pyspark.sql import functions as F

from docketry.sources.sinks import export, mirror, raw_objects, write_once
from docketry.streaming.streams import debounce, insert_if_absent, miss_streaks, read_stream, run_available, windowed_counts


def feed(spark, tmp_path, rows, schema):
    path = str(tmp_path / "in")
    for k, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return read_stream(spark, path, files_per_trigger=1)


def at(minute):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute)


def test_windows_and_late_rows(spark, tmp_path):
    s = feed(spark, tmp_path, [[(at(1), "a"), (at(2), "a")], [(at(200), "a")], [(at(201), "a")], [(at(3), "a"), (at(400), "a")]], "ts timestamp, k string")
    out = run_available(windowed_counts(s, "ts", "k", "1 hour", "10 minutes"), "w", uuid.uuid4().hex)
    got = {(r["start"], r["n"]) for r in spark.read.parquet(out).collect()}
    assert (at(0), 2) in got and (at(180), 2) in got  # the row at minute 3 came too late


def test_debounce_and_insert(spark, tmp_path):
    s = feed(spark, tmp_path, [[(1, at(1), "a"), (2, at(5), "a"), (3, at(2), "b"), (4, at(11), "a")], [(5, at(20), "a"), (6, at(21), "a"), (7, at(22), "b"), (8, None, "c")]], "n int, ts timestamp, k string")
    out = run_available(debounce(s, ["k"], "ts", "n", 600), "d", uuid.uuid4().hex)
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == [1, 3, 4, 6, 7]
    target = str(tmp_path / "table")
    for batch in (["x", "y", "y", None], ["y", "z"], ["y", "z"]):
        insert_if_absent(spark.createDataFrame([(b,) for b in batch], "k string"), target, "k")
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == ["x", "y", "z"]


def test_streaks_carry_over_batches(spark, tmp_path):
    s = feed(spark, tmp_path, [[(1, "a", True), (2, "a", True)], [(3, "a", True), (4, "a", False), (1, "b", None)]], "o int, k string, m boolean")
    target = str(tmp_path / "out")
    run_available(miss_streaks(s, "k", "o", "m", 3), "s", uuid.uuid4().hex, "update", lambda b, _: b.write.mode("append").parquet(target))
    got = spark.read.parquet(target).groupBy("k").agg(F.max("seen"), F.max("longest"), F.max("closed")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", 4, 3, True), ("b", 1, 0, False)]


def test_sinks(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.bin").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "raw/b.bin").write_bytes(b"<!DOCTYPE html><html>")
    (tmp_path / "raw/c.bin").write_bytes(b"")
    (tmp_path / "raw/d.bin").write_bytes(b"\xff\xd8\xff\xe0")
    assert sorted(r["kind"] for r in raw_objects(spark, str(tmp_path / "raw")).collect()) == ["html", "image", "pdf"]
    df = spark.createDataFrame([("1", "s", 3), ("2", "s", 4), ("2", "s", 4), (None, "s", 1)], "h string, source string, n int")
    assert write_once(df, str(tmp_path / "store"), "h", ["source"]) == 2
    assert write_once(df, str(tmp_path / "store"), "h", ["source"]) == 0
    texts = spark.createDataFrame([("a", "line\n\"quoted\", text", False), ("b", "hidden", True)], "id string, full_text string, locked boolean")
    export(texts, str(tmp_path / "json"), "jsonl", "locked")
    assert {r["full_text"] for r in spark.read.json(str(tmp_path / "json")).collect()} == {'line\n"quoted", text', "[restricted]"}
    export(texts.drop("locked"), str(tmp_path / "csv"), "csv")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert {r["full_text"] for r in back.collect()} == {'line\n"quoted", text', "hidden"}
    ledger = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, n int")
    listing = spark.createDataFrame([("a", 1), ("b", 9), ("d", 4)], "k string, n int")
    assert sorted(map(tuple, mirror(ledger, listing, "k", "n").collect())) == [("a", "ok"), ("b", "mismatch"), ("c", "missing"), ("d", "unlisted")]
