"""Ordered sections: splitting, numbering gaps, bogus numbers, merges and the gate for a re-extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Limits of the numbering rules.
YEAR_LOW, YEAR_HIGH, MOST_SECTIONS, NO_RUN = 1800, 2100, 5000, 10_000
SUBSTANTIVE_CHARS = 40


def real_numbers(numbers: Column) -> Column:
    """Section integers without years and numbers beyond any act, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.filter(numbers, lambda n: n.isNotNull() & ~n.between(YEAR_LOW, YEAR_HIGH) & (n <= MOST_SECTIONS))))


def missing_in_run(numbers: Column, run_end: Column) -> Column:
    """How many of 1..run_end are absent; NO_RUN where there is no run."""
    present = F.size(F.filter(real_numbers(numbers), lambda n: n.between(1, run_end)))
    return F.when((F.size(real_numbers(numbers)) == 0) | (run_end <= 0), NO_RUN).otherwise(run_end - present)


def is_fake_number(n: Column, numbers: Column) -> Column:
    """A year, a number beyond any act, or one of 100 or more that is far off the others."""
    others = F.filter(real_numbers(numbers), lambda x: x != n)
    size = F.size(others)
    typical = F.when(size == 0, 0).when(size == 1, F.try_element_at(others, F.lit(1))).otherwise(F.greatest(F.try_element_at(others, F.floor(size / 2).cast("int") + 1), F.try_element_at(others, F.greatest(size - 1, F.lit(1)))))
    return F.coalesce(n.between(YEAR_LOW, YEAR_HIGH) | (n > MOST_SECTIONS) | ((n > typical + 5) & (n >= 100)), F.lit(False))


def carry_forward_merge(sections: DataFrame, doc: str, order: str, bogus: Column, text: str) -> DataFrame:
    """Sections with the texts of the bogus ones that follow appended in order: (doc, order, text, merged).

    A bogus section before any real one, or of blank text, is appended to nothing. A document's sections are bounded
    by what an act has.
    """
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    marked = sections.withColumn("_bogus", F.coalesce(bogus, F.lit(False))).withColumn("_into", F.last(F.when(~F.col("_bogus"), F.col(order)), ignorenulls=True).over(w))
    kept = marked.where(F.col("_into").isNotNull() & (~F.col("_bogus") | (F.length(F.trim(F.coalesce(text, F.lit("")))) > 0)))
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return kept.groupBy(doc, "_into").agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n").alias(text), (F.count(F.lit(1)) - 1).alias("merged")).withColumnRenamed("_into", order)


def split_sections(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, ordinal, section_number, section_text) of texts with numbered headings at line starts; a text without one is one section of null number."""
    marked = F.regexp_replace(F.col(text), r"(?m)^(?=(?:Section )?[0-9]+[A-Z]?(?:-[A-Z])?\. )", "\x01")
    parts = F.filter(F.split(marked, "\x01"), lambda p: F.length(F.trim(p)) > 0)
    rows = docs.where(F.length(F.trim(F.coalesce(F.col(text), F.lit("")))) > 0).select(id_col, F.posexplode(parts).alias("ordinal", "_part"))
    head = r"^(?:Section )?([0-9]+[A-Z]?(?:-[A-Z])?)\. "
    return rows.select(id_col, F.col("ordinal").cast("int"), F.nullif(F.regexp_extract("_part", head, 1), F.lit("")).alias("section_number"), F.regexp_replace(F.regexp_replace("_part", head, ""), r"^\s+|\s+$", "").alias("section_text"))


def fuller_text_wins(sections: DataFrame, doc: str, number: str, text: str, order: str) -> DataFrame:
    """One section per number: the longest text, the first in order on ties."""
    best = F.max(F.struct(F.length(F.coalesce(F.col(text), F.lit(""))).alias("n"), (-F.col(order)).alias("o"), F.col(text).alias("t")))
    return sections.where(F.col(number).isNotNull()).groupBy(doc, number).agg(best.alias("_b")).select(doc, number, F.col("_b.t").alias(text))


def reextract_gate(before: DataFrame, after: DataFrame, doc: str, number: str, text: str, allowance: int = 2) -> DataFrame:
    """(doc, kept, lost, verdict) of a re-extraction: what was empty passes; else the first fault of lost_half, lost_first, mega_section."""
    b = before.select(F.col(doc).alias("doc"), F.col(number).alias("number")).distinct()
    a = after.groupBy(F.col(doc).alias("doc"), F.col(number).alias("number")).agg(F.max(F.length(text)).alias("chars"))
    both = b.withColumn("_b", F.lit(1)).join(a.withColumn("_a", F.lit(1)), ["doc", "number"], "full_outer")
    agg = both.groupBy("doc").agg(
        F.count_if(F.col("_b").isNotNull()).alias("had"),
        F.count_if(F.col("_b").isNotNull() & F.col("_a").isNotNull()).alias("kept"),
        F.count_if(F.col("_b").isNotNull() & F.col("_a").isNull()).alias("lost"),
        F.count_if((F.col("number") == "1") & F.col("_b").isNotNull() & F.col("_a").isNull()).alias("lost_first"),
        F.coalesce(F.max("chars"), F.lit(0)).alias("longest"),
    )
    verdict = (
        F.when(F.col("had") == 0, "pass")
        .when((F.col("kept") * 2 < F.col("had")) & (F.col("lost") > allowance), "lost_half")
        .when(F.col("lost_first") > 0, "lost_first")
        .when(F.col("longest") > 20000, "mega_section")
        .otherwise("pass")
    )
    return agg.select("doc", "kept", "lost", verdict.alias("verdict"))
