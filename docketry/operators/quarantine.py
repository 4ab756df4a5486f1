"""Marks that take records out of service and can be taken back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_marks(records: DataFrame, key: str, marks: DataFrame, state: str, marked: str) -> tuple[DataFrame, DataFrame]:
    """(records with ``state`` set to ``marked`` for every marked key, the rows (key, state) as they were before).

    Marks are reduced to distinct keys; keys of no record change nothing, and a record in the state already is not noted, so
    that an undo gives back what was there and nothing else.
    """
    wanted = marks.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn("_mark", F.lit(True))
    joined = records.join(wanted, key, "left")
    changes = F.col("_mark") & ~F.col(state).eqNullSafe(F.lit(marked))
    before = joined.where(changes).select(key, state)
    return joined.withColumn(state, F.when(F.col("_mark"), F.lit(marked)).otherwise(F.col(state))).drop("_mark"), before


def undo_marks(records: DataFrame, key: str, before: DataFrame, state: str) -> DataFrame:
    """Records with the states that ``before`` (key, state) noted; all other records as they are."""
    old = before.select(key, F.col(state).alias("_old"), F.lit(True).alias("_noted"))
    return records.join(old, key, "left").withColumn(state, F.when(F.col("_noted"), F.col("_old")).otherwise(F.col(state))).drop("_old", "_noted")
