"""Readers and sinks beside Parquet: raw files, write-once stores, exports with an index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.urls import has_pdf_signature, is_image_bytes


def raw_objects(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files as rows (path, length, modified, content_hash, kind), read as binary; the kind is pdf, image, html or other by content. Empty files are no rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    head = F.lower(F.decode(F.substring("content", 1, 256), "ISO-8859-1"))
    kind = F.when(has_pdf_signature(F.col("content")), "pdf").when(is_image_bytes(F.col("content")), "image").when(F.contains(head, F.lit("<html")) | F.contains(head, F.lit("<!doctype")), "html").otherwise("other")
    return files.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("content_hash"), kind.alias("kind"))


def write_once(df: DataFrame, target: str, key: str, partition: list[str]) -> int:
    """Rows whose key the target lacks, appended under partition folders; the number of rows that were new.

    The target is read for its keys alone. The same rows written again add nothing.
    """
    spark = df.sparkSession
    fresh = df.where(F.col(key).isNotNull()).dropDuplicates([key])
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(target)
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        fresh = fresh.join(spark.read.parquet(target).select(key), key, "left_anti")
    before = spark.read.parquet(target).count() if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there) else 0
    fresh.write.mode("append").partitionBy(*partition).parquet(target)
    return spark.read.parquet(target).count() - before


def export(df: DataFrame, target: str, form: str = "jsonl", restricted: str | None = None, text: str = "full_text") -> None:
    """Rows as JSON lines or CSV; with ``restricted``, a boolean column, the text of restricted rows is masked."""
    out = df if restricted is None else df.withColumn(text, F.when(F.col(restricted), "[restricted]").otherwise(F.col(text))).drop(restricted)
    if form == "jsonl":
        out.write.mode("overwrite").json(target)
    elif form == "csv":
        out.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(target)
    else:
        raise ValueError(f"no such form: {form}")


def mirror(ledger: DataFrame, listing: DataFrame, key: str, size: str) -> DataFrame:
    """(key, state) of a ledger against a listing of what is stored: ok, missing, mismatch by size, or unlisted."""
    a = ledger.select(key, F.col(size).alias("_want"), F.lit(1).alias("_in"))
    b = listing.select(key, F.col(size).alias("_have"), F.lit(1).alias("_there"))
    state = F.when(F.col("_in").isNull(), "unlisted").when(F.col("_there").isNull(), "missing").when(F.col("_want").eqNullSafe(F.col("_have")), "ok").otherwise("mismatch")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))
