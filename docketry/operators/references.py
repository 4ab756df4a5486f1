"""References to records that do not exist: absent, deleted, or younger than the row that names them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.skew import hot_keys, skew_join


def reference_key(id_: Column) -> Column:
    """An id as it is compared: lower case, surrounding blanks off; null for null, blank and all-zero ids."""
    bare = F.lower(F.regexp_replace(id_, r"^\s+|\s+$", ""))
    return F.when((bare == "") | bare.rlike(r"^[0-]*0[0-]*$"), F.lit(None)).otherwise(bare)


def orphan_references(
    refs: DataFrame,
    record_id: Column,
    foreign_key: Column,
    referred_at: Column,
    parents: DataFrame,
    parent_id: Column,
    parent_at: Column,
    deleted_ids: DataFrame,
) -> DataFrame:
    """Orphans as (record_id, period yyyy-MM, orphan_kind late | deleted | missing).

    Foreign keys are reduced to the distinct non-null ones with their earliest reference before anything is joined;
    a left join against the reduced parents drops all keys whose parent is older than every reference, so that only
    keys with an orphan go back to the rows. A parent that exists is never 'deleted', whatever the deletions say.
    Parents with several rows count by the earliest. A null time on either side can't be late; its period is null.
    Hot foreign keys are salted on the way back.
    """
    rows = refs.select(record_id.alias("record_id"), reference_key(foreign_key).alias("_fk"), referred_at.alias("_ts")).where(F.col("_fk").isNotNull())
    keys = rows.groupBy("_fk").agg(F.min("_ts").alias("_first"), F.count(F.lit(1)).alias("n"))
    known = (
        parents.select(reference_key(parent_id).alias("_fk"), parent_at.alias("_at"))
        .where(F.col("_fk").isNotNull())
        .groupBy("_fk")
        .agg(F.min("_at").alias("_born"), F.lit(1).alias("_known"))
    )
    gone = deleted_ids.toDF("_fk").select(reference_key(F.col("_fk")).alias("_fk")).where(F.col("_fk").isNotNull()).distinct().withColumn("_gone", F.lit(1))
    broken = (
        keys.join(known, "_fk", "left")
        .where(F.col("_known").isNull() | (F.col("_born") > F.col("_first")))
        .join(gone, "_fk", "left")
        .select("_fk", "_born", "_known", "_gone")
    )
    hot = hot_keys(rows, "_fk", counts=keys.select("_fk", "n"))
    back = skew_join(rows, broken, "_fk", "inner", salt_by=F.col("record_id"), hot=hot)
    kind = F.when(F.col("_known").isNull(), F.when(F.col("_gone").isNotNull(), "deleted").otherwise("missing")).when(F.col("_born") > F.col("_ts"), "late")
    return back.select("record_id", F.date_format("_ts", "yyyy-MM").alias("period"), kind.alias("orphan_kind")).where(F.col("orphan_kind").isNotNull())


def orphan_report(orphans: DataFrame, by: list[str]) -> DataFrame:
    """Orphans counted per ``by``; counts are partial before the shuffle."""
    return orphans.groupBy(*by).agg(F.count(F.lit(1)).alias("orphans"))
