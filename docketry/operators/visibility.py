"""Which records may be served: the overlay of deletions and quarantine marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def servable(records: DataFrame, key: str, marks: DataFrame, mark_key: str) -> DataFrame:
    """Records without a mark; marks are reduced to distinct keys first. Records of null key carry no mark and stay."""
    return records.join(marks.select(F.col(mark_key).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def quarantined(records: DataFrame, key: str, marks: DataFrame, mark_key: str) -> DataFrame:
    """Records with a mark, each once."""
    return records.join(marks.select(F.col(mark_key).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def page(df: DataFrame, order: list, limit: int, offset: int = 0) -> DataFrame:
    """One page of an ordered listing; the order must be total."""
    return df.orderBy(*order).offset(offset).limit(limit)
