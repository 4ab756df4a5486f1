"""The staged pipeline: reconciliation of two readings, and the outcome of each record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import collapse
from docketry.operators.skew import skew_join


def evidenced(value: Column, text: Column) -> Column:
    """Whether a value stands in the text, the whole of it, without regard to case and white space."""
    norm = lambda c: F.lower(collapse(F.coalesce(c, F.lit(""))))
    return (F.length(norm(value)) > 0) & F.contains(norm(text), norm(value))


def reconcile(first: Column, second: Column, text: Column) -> tuple[Column, Column]:
    """(value, conflict) of a field from two readings: the first wins, the second counts only with evidence in the text; a second without is a conflict."""
    ok = evidenced(second, text)
    return F.coalesce(first, F.when(ok, second)), F.coalesce(first.isNull() & second.isNotNull() & ~ok, F.lit(False))


def confidence(base: Column, conflicts: Column, errors: Column, complete: Column) -> Column:
    """Confidence after the penalties: a tenth per conflict, a twentieth per error, at most 0.4 where a mandatory field is missing, within 0 and 1."""
    c = base - 0.1 * conflicts - 0.05 * errors
    c = F.when(complete, c).otherwise(F.least(c, F.lit(0.4)))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)), 3)


def outcomes(df: DataFrame, identity: list[str], order: list[str], holds: list[tuple[str, Column]]) -> DataFrame:
    """Rows with ``outcome`` (promoted, duplicate or quarantined) and ``reason``.

    The first hold that applies quarantines a row. Of the sound rows of one identity the first in order is promoted and
    the others are its duplicates; a row with a null in its identity has no equal. One pass stands for the one-by-one
    procedure, in which the earlier rows are the corpus. The first of an identity is an aggregate; no group is sorted. The
    last of the ``order`` columns must be unique.
    """
    hold = None
    for reason, when in holds:
        hold = F.when(F.coalesce(when, F.lit(False)), reason) if hold is None else hold.when(F.coalesce(when, F.lit(False)), reason)
    marked = df.withColumn("_hold", hold)
    whole = F.lit(True)
    for k in identity:
        whole = whole & F.col(k).isNotNull()
    marked = marked.withColumn("_key", F.when(whole & F.col("_hold").isNull(), F.to_json(F.struct(*identity)))).withColumn("_at", F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)]))
    first = marked.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("_at").alias("_first"))
    ranked = skew_join(marked.where(F.col("_key").isNotNull()), first, "_key", salt_by=F.col("_at")).withColumn("_later", F.col("_at") != F.col("_first")).drop("_first")
    ranked = ranked.unionByName(marked.where(F.col("_key").isNull()).withColumn("_later", F.lit(False)))
    outcome = F.when(F.col("_hold").isNotNull(), "quarantined").when(F.col("_later"), "duplicate").otherwise("promoted")
    return ranked.withColumn("outcome", outcome).withColumn("reason", F.coalesce("_hold", F.when(F.col("_later"), "same identity"))).drop("_hold", "_key", "_at", "_later")
