"""Queries that run a stream over what is available and return its result."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docketry.plans.registry import CORE
from docketry.streaming.streams import debounce, in_slices, insert_if_absent, miss_streaks, read_stream, run_available, windowed_counts


def _events(spark, sf):
    return read_stream(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@CORE.query("stream_windows", "WITH h AS (SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT strftime(start, '%Y-%m-%d') AS day, event_type, n FROM h WHERE start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def stream_windows(spark, sf):
    """Daily counts as the stream emits them: the windows that the watermark has passed."""
    out = run_available(windowed_counts(_events(spark, sf), "ts", "event_type", "1 day", "1 hour"), "windows", uuid.uuid4().hex)
    return spark.read.parquet(out).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def _sliced(spark, sf, run: str):
    """The events as a stream of two batches, the earlier half of their time first."""
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    return read_stream(spark, in_slices(e, "ts", 2, f"events-{run}"), 1)


@CORE.query(
    "stream_debounce",
    """WITH RECURSIVE o AS (SELECT user_id, event_type, ts, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events WHERE ts IS NOT NULL),
    r AS (SELECT user_id, event_type, ts, event_id, rn, ts AS last, true AS passed FROM o WHERE rn = 1
      UNION ALL SELECT o.user_id, o.event_type, o.ts, o.event_id, o.rn, CASE WHEN o.ts - r.last >= INTERVAL 10 MINUTE THEN o.ts ELSE r.last END, o.ts - r.last >= INTERVAL 10 MINUTE FROM r JOIN o ON o.user_id = r.user_id AND o.event_type = r.event_type AND o.rn = r.rn + 1)
    SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM r WHERE passed""",
)
def stream_debounce(spark, sf):
    """The requests that are let through, over two batches: those ten minutes or more after the last of their key that was."""
    run = uuid.uuid4().hex
    out = run_available(debounce(_sliced(spark, sf, run), ["user_id", "event_type"], "ts", "event_id", 600), "debounce", run)
    return spark.read.parquet(out).select("user_id", "event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@CORE.query(
    "stream_insert_if_absent",
    "WITH m AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events) SELECT user_id, CAST(min((epoch_us(ts) - low) // ((high - low) // 2 + 1)) AS INTEGER) AS slice FROM events, m GROUP BY 1",
)
def stream_insert_if_absent(spark, sf):
    """Keys inserted by two micro-batches, each with the batch that brought it first."""
    from docketry.session import ensure_checkpoint_dir

    run = uuid.uuid4().hex
    target = f"{ensure_checkpoint_dir(spark)}/streams/frontier-{run}/table"
    run_available(_sliced(spark, sf, run).select("user_id", "slice"), "frontier", run, "append", lambda batch, _: insert_if_absent(batch, target, "user_id"))
    return spark.read.parquet(target)


@CORE.query(
    "stream_miss_streaks",
    """WITH m AS (SELECT user_id, ts, event_id, event_type = 'view' AS miss FROM events), o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, miss ORDER BY ts, event_id) AS island FROM m),
    l AS (SELECT user_id, count(*) AS n FROM o WHERE miss GROUP BY user_id, island) SELECT e.user_id, count(*) AS seen, coalesce((SELECT max(n) FROM l WHERE l.user_id = e.user_id), 0) AS longest FROM events e GROUP BY 1""",
)
def stream_miss_streaks(spark, sf):
    """The last state of each key's streak, folded by a stateful operator."""
    from docketry.session import ensure_checkpoint_dir

    run = uuid.uuid4().hex
    target = f"{ensure_checkpoint_dir(spark)}/streams/streaks-{run}/table"
    folded = miss_streaks(_events(spark, sf).select("user_id", "ts", "event_id", (F.col("event_type") == "view").alias("miss")), "user_id", "ts", "miss", 5)
    run_available(folded, "streaks", run, "update", lambda batch, _: batch.write.mode("append").parquet(target))
    return spark.read.parquet(target).groupBy("user_id").agg(F.max("seen").alias("seen"), F.max("longest").alias("longest"))
