"""Structured Streaming forms of the stateful operators; each has a batch twin among the queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docketry.session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """A folder or file of Parquet as a stream, with the schema of what is there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(there).isFile():
        # the source lists folders: a single file is its folder, narrowed to the file's name
        return reader.option("pathGlobFilter", there.getName()).parquet(there.getParent().toString())
    return reader.parquet(path)


def windowed_counts(events: DataFrame, at: str, key: str, window: str, delay: str) -> DataFrame:
    """Counts per key and tumbling window under a watermark: a window is emitted once, when it can't change any more."""
    return events.withWatermark(at, delay).groupBy(F.window(at, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def debounce(events: DataFrame, keys: list[str], at: str, order: str, seconds: int) -> DataFrame:
    """The rows (keys, order, at) that are let through: those at least ``seconds`` after the last of their key that was.

    The state of a key is one time, however many rows it has; rows of a batch are taken in time order, ties by ``order``.
    """
    kinds = dict(events.dtypes)

    def pass_through(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values([at, order], kind="stable")
        kept = []
        for n, t in enumerate(rows[at].astype("datetime64[us]").astype("int64")):
            if last is None or t - last >= seconds * 1_000_000:
                kept.append(n)
                last = int(t)
        if last is not None:
            state.update((last,))
        yield rows.iloc[kept][[*keys, order, at]]

    schema = ", ".join(f"{c} {kinds[c]}" for c in [*keys, order, at])
    return events.where(F.col(at).isNotNull()).groupBy(*keys).applyInPandasWithState(pass_through, schema, "last bigint", "append", GroupStateTimeout.NoTimeout)


def in_slices(df: DataFrame, at: str, slices: int, name: str) -> str:
    """The rows written to the shared folder in ``slices`` files of equal spans of time, oldest first, for a stream to read one a batch; the folder."""
    target = f"{ensure_checkpoint_dir(df.sparkSession)}/streams/{name}"
    t = F.unix_micros(F.col(at).cast("timestamp"))
    low, high = df.agg(F.min(t), F.max(t)).first()
    span = ((high or 0) - (low or 0)) // slices + 1
    for k in range(slices):
        part = df.where(F.coalesce(F.floor((t - F.lit(low or 0)) / span), F.lit(0)) == k) if low is not None else df
        part.withColumn("slice", F.lit(k)).coalesce(1).write.mode("append").parquet(target)
    return target


def miss_streaks(events: DataFrame, key: str, order: str, miss: str, close_at: int) -> DataFrame:
    """(key, seen, longest, closed) updated with every batch: the longest run of misses so far, and whether it closes the key.

    The state of a key is three numbers, however many events it has.
    """

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, run, longest = state.get if state.exists else (0, 0, 0)
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        for hit in rows[miss].fillna(False):
            seen += 1
            run = run + 1 if hit else 0
            longest = max(longest, run)
        state.update((seen, run, longest))
        yield pd.DataFrame({key: [group[0]], "seen": [seen], "longest": [longest], "closed": [longest >= close_at]})

    kind = dict(events.dtypes)[key]
    return events.groupBy(key).applyInPandasWithState(
        fold, f"{key} {kind}, seen bigint, longest bigint, closed boolean", "seen bigint, run bigint, longest bigint", "update", GroupStateTimeout.NoTimeout
    )


def insert_if_absent(batch: DataFrame, target: str, key: str) -> None:
    """Rows of a batch whose key the target folder lacks, each key once; a batch that is delivered again adds nothing."""
    spark = batch.sparkSession
    fresh = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
    try:
        held = spark.read.parquet(target).select(key)
    except Exception as missing:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER" not in str(missing):
            raise
        held = None
    (fresh if held is None else fresh.join(held, key, "left_anti")).write.mode("append").parquet(target)


def run_available(stream: DataFrame, name: str, run: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> str:
    """All that is available through the stream once; the folder of the result. Result and progress are in the shared folder."""
    base = f"{ensure_checkpoint_dir(stream.sparkSession)}/streams/{name}-{run}"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True)
    if each is None:
        query = writer.format("parquet").option("path", f"{base}/out").start()
    else:
        query = writer.foreachBatch(each).start()
    query.awaitTermination()
    return f"{base}/out"
