"""Queries for histories (p3) and references (p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators.history import text_key, version_history
from docketry.operators.references import orphan_references, orphan_report
from docketry.plans.registry import CORE
from docketry.sources.tables import table

_SPACES_SQL = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

_P3_SQL = f"""
WITH caps AS (
  SELECT section_id, effective_from, coalesce(md5(regexp_replace(section_text, '{_SPACES_SQL}', '', 'g')), 'null') AS h,
         row_number() OVER (PARTITION BY section_id, effective_from ORDER BY created_at DESC NULLS LAST, id DESC) AS rn
  FROM statute_section_version WHERE effective_from IS NOT NULL AND section_id IS NOT NULL),
marked AS (
  SELECT *, lag(h) OVER (PARTITION BY section_id ORDER BY effective_from) AS before FROM caps WHERE rn = 1),
starts AS (SELECT section_id, effective_from FROM marked WHERE before IS NULL OR before <> h)
SELECT section_id,
       CAST(row_number() OVER w AS INTEGER) AS version_no,
       strftime(effective_from, '%Y-%m-%d') AS valid_from,
       coalesce(strftime(CAST(lead(effective_from) OVER w AS DATE) - 1, '%Y-%m-%d'), '') AS valid_to
FROM starts WINDOW w AS (PARTITION BY section_id ORDER BY effective_from)
"""


@CORE.query("p3_found", _P3_SQL)
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ssv = table(spark, sf_dir, "statute_section_version")
    history = version_history(ssv, ["section_id"], "effective_from", "created_at", "id", text_key(F.col("section_text")))
    return history.select(
        "section_id",
        "version_no",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit("")).alias("valid_to"),
    )


_KEY = "CASE WHEN regexp_matches(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '^[0-]*0[0-]*$') OR regexp_replace({0}, '^\\s+|\\s+$', '', 'g') = '' THEN NULL ELSE lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')) END"

_P4_CTE = f"""
WITH refs AS (
  SELECT 'statute_section_version' AS source_table, 'instrument' AS parent_table, id AS record_id, {_KEY.format('amending_instrument_id')} AS fk, created_at AS ts FROM statute_section_version
  UNION ALL
  SELECT 'judgment_upload_work', 'judgment', CAST(work_id AS VARCHAR), {_KEY.format('judgment_id')}, queued_at FROM judgment_upload_work),
parents AS (
  SELECT parent_table, fk, min(created_at) AS born FROM (
    SELECT 'instrument' AS parent_table, {_KEY.format('id')} AS fk, created_at FROM instrument
    UNION ALL SELECT 'judgment', {_KEY.format('id')}, created_at FROM judgment) WHERE fk IS NOT NULL GROUP BY ALL),
gone AS (SELECT DISTINCT table_name AS parent_table, {_KEY.format('record_id')} AS fk FROM deleted_record),
judged AS (
  SELECT r.source_table, strftime(r.ts, '%Y-%m') AS period, r.record_id,
         CASE WHEN p.fk IS NULL THEN CASE WHEN g.fk IS NOT NULL THEN 'deleted' ELSE 'missing' END
              WHEN p.born > r.ts THEN 'late' END AS orphan_kind
  FROM refs r LEFT JOIN parents p ON p.parent_table = r.parent_table AND p.fk = r.fk
       LEFT JOIN gone g ON g.parent_table = r.parent_table AND g.fk = r.fk
  WHERE r.fk IS NOT NULL)
"""


@CORE.query("p4_found", _P4_CTE + "SELECT source_table, period, record_id, orphan_kind FROM judged WHERE orphan_kind IS NOT NULL")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    deleted = table(spark, sf_dir, "deleted_record")

    def of(source: str, id_: str, fk: str, ts: str, parent: str) -> DataFrame:
        parents = table(spark, sf_dir, parent)
        found = orphan_references(
            table(spark, sf_dir, source),
            F.col(id_).cast("string"),
            F.col(fk),
            F.col(ts),
            parents,
            F.col("id"),
            F.col("created_at"),
            deleted.where(F.col("table_name") == parent).select("record_id"),
        )
        return found.select(F.lit(source).alias("source_table"), "period", "record_id", "orphan_kind")

    return of("statute_section_version", "id", "amending_instrument_id", "created_at", "instrument").unionByName(
        of("judgment_upload_work", "work_id", "judgment_id", "queued_at", "judgment")
    )


@CORE.query("p4_report", _P4_CTE + "SELECT source_table, period, orphan_kind, count(*) AS orphans FROM judged WHERE orphan_kind IS NOT NULL GROUP BY ALL")
def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(p4_found(spark, sf_dir), ["source_table", "period", "orphan_kind"])
