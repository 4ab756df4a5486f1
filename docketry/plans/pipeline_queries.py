"""Staging, reconciliation, identity and versions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docketry.functions.text import fit_key, slug
from docketry.operators.dedupe import keeper_ranks
from docketry.operators.identity import reconcile_identity
from docketry.operators.staging import confidence, evidenced, outcomes, reconcile
from docketry.plans.registry import CORE
from docketry.sources.tables import table


@CORE.query(
    "identity_reconcile",
    """WITH u AS (SELECT id, full_text_hash AS h, court_id, docket_key, decision_date FROM judgment WHERE unreported), r AS (SELECT id, full_text_hash AS h, court_id, docket_key, decision_date FROM judgment WHERE NOT unreported),
    p AS (SELECT u.id AS probe_id, r.id AS build_id, u.h = r.h AS same FROM u JOIN r USING (court_id, docket_key, decision_date)),
    e AS (SELECT probe_id, count(*) AS n, min(build_id) AS build_id FROM p WHERE same GROUP BY 1), a AS (SELECT probe_id FROM e WHERE n > 1)
    SELECT probe_id, CASE WHEN n = 1 THEN build_id END AS build_id, CASE WHEN n = 1 THEN 'linked' ELSE 'ambiguous' END AS outcome FROM e
    UNION ALL SELECT probe_id, build_id, 'same_identity_different_text' FROM p WHERE NOT same AND probe_id NOT IN (SELECT probe_id FROM a)
    UNION ALL SELECT u.id, r.id, 'hash_mismatch' FROM u JOIN r ON u.h = r.h WHERE u.court_id IS NOT NULL AND u.docket_key IS NOT NULL AND u.decision_date IS NOT NULL
      AND NOT (coalesce(u.court_id = r.court_id, false) AND coalesce(u.docket_key = r.docket_key, false) AND coalesce(u.decision_date = r.decision_date, false)) AND u.id NOT IN (SELECT probe_id FROM a)""",
)
def identity_reconcile(spark, sf):
    """Unreported judgments against reported ones of the same court, docket and date of decision."""
    j = table(spark, sf, "judgment").select("id", F.col("full_text_hash").alias("text_hash"), "court_id", "docket_key", "decision_date", "unreported")
    return reconcile_identity(j.where("unreported"), j.where("not unreported"), ["court_id", "docket_key", "decision_date"])


_NORM = "lower(trim(regexp_replace(replace(coalesce({0}, ''), chr(160), ' '), '\\s+', ' ', 'g')))"


@CORE.query(
    "reconcile_fields",
    f"""WITH m AS (SELECT j.id, j.docket_number AS d1, m.docket_number AS d2, j.full_text, j.confidence_score, j.case_title, j.court_id FROM judgment j JOIN (SELECT judgment_id, min(docket_number) AS docket_number FROM case_metadata GROUP BY 1) m ON m.judgment_id = j.id),
    e AS (SELECT *, length({_NORM.format('d2')}) > 0 AND contains({_NORM.format('full_text')}, {_NORM.format('d2')}) AS ok FROM m),
    c AS (SELECT *, coalesce(d1, CASE WHEN ok THEN d2 END) AS docket, coalesce(d1 IS NULL AND d2 IS NOT NULL AND NOT ok, false) AS conflict FROM e)
    SELECT id, docket, conflict, round(greatest(0.0, least(1.0, CASE WHEN case_title IS NOT NULL AND court_id IS NOT NULL THEN confidence_score - 0.1 * conflict::INT ELSE least(confidence_score - 0.1 * conflict::INT, 0.4) END)), 3) AS confidence FROM c""",
)
def reconcile_fields(spark, sf):
    """The docket number from two readings, with the conflict and the confidence that is left."""
    m = table(spark, sf, "case_metadata").groupBy("judgment_id").agg(F.min("docket_number").alias("d2"))
    j = table(spark, sf, "judgment").select("id", F.col("docket_number").alias("d1"), "full_text", "confidence_score", "case_title", "court_id").join(m, F.col("id") == F.col("judgment_id"))
    value, conflict = reconcile(F.col("d1"), F.col("d2"), F.col("full_text"))
    done = j.select("id", value.alias("docket"), conflict.alias("conflict"), "confidence_score", (F.col("case_title").isNotNull() & F.col("court_id").isNotNull()).alias("complete"))
    return done.select("id", "docket", "conflict", confidence(F.col("confidence_score"), F.col("conflict").cast("int"), F.lit(0), F.col("complete")).alias("confidence"))


@CORE.query(
    "headnote_evidence",
    f"SELECT m.case_id, length({_NORM.format('m.headnotes')}) > 0 AND contains({_NORM.format('j.full_text')}, {_NORM.format('m.headnotes')}) AS evidenced FROM case_metadata m JOIN judgment j ON j.id = m.judgment_id WHERE m.headnotes IS NOT NULL",
)
def headnote_evidence(spark, sf):
    """Whether a headnote stands in its judgment."""
    m = table(spark, sf, "case_metadata").where("headnotes is not null").select("case_id", "judgment_id", "headnotes")
    j = table(spark, sf, "judgment").select(F.col("id").alias("judgment_id"), "full_text")
    return m.join(j, "judgment_id").select("case_id", evidenced(F.col("headnotes"), F.col("full_text")).alias("evidenced"))


@CORE.query(
    "promote_outcomes",
    """WITH b AS (SELECT id, case_title, court_name, created_at, CASE WHEN full_text IS NULL OR trim(full_text) = '' THEN 'no body' WHEN length(trim(full_text)) < 200 THEN 'thin body' WHEN case_title IS NULL THEN 'no title' WHEN confidence_score < 0.5 THEN 'low confidence' END AS hold FROM judgment),
    r AS (SELECT *, CASE WHEN hold IS NULL AND case_title IS NOT NULL AND court_name IS NOT NULL THEN row_number() OVER (PARTITION BY hold IS NULL, case_title, court_name ORDER BY created_at, id) ELSE 1 END AS rn FROM b)
    SELECT id, CASE WHEN hold IS NOT NULL THEN 'quarantined' WHEN rn > 1 THEN 'duplicate' ELSE 'promoted' END AS outcome, coalesce(hold, CASE WHEN rn > 1 THEN 'same identity' END) AS reason FROM r""",
)
def promote_outcomes(spark, sf):
    t = F.col("full_text")
    holds = [("no body", t.isNull() | (F.trim(t) == "")), ("thin body", F.length(F.trim(t)) < 200), ("no title", F.col("case_title").isNull()), ("low confidence", F.col("confidence_score") < 0.5)]
    j = table(spark, sf, "judgment").select("id", "case_title", "court_name", "created_at", "full_text", "confidence_score")
    return outcomes(j, ["case_title", "court_name"], ["created_at", "id"], holds).select("id", "outcome", "reason")


@CORE.query(
    "outcome_counts",
    "SELECT CASE WHEN full_text IS NULL OR trim(full_text) = '' THEN 'no body' WHEN length(trim(full_text)) < 200 THEN 'thin body' ELSE 'kept' END AS reason, count(*) AS n FROM judgment GROUP BY 1",
)
def outcome_counts(spark, sf):
    t = F.col("full_text")
    reason = F.when(t.isNull() | (F.trim(t) == ""), "no body").when(F.length(F.trim(t)) < 200, "thin body").otherwise("kept")
    return table(spark, sf, "judgment").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@CORE.query(
    "superseded_captures",
    "SELECT w.work_id FROM judgment_upload_work w WHERE EXISTS (SELECT 1 FROM judgment_upload_work o WHERE o.target_id = w.target_id AND o.queued_at > w.queued_at)",
)
def superseded_captures(spark, sf):
    """Queued work that a later one of the same target supersedes: one aggregate per target in place of a self-join."""
    w = table(spark, sf, "judgment_upload_work").select("work_id", "target_id", "queued_at")
    last = w.groupBy("target_id").agg(F.max("queued_at").alias("_last"))
    return w.join(last, "target_id").where("queued_at < _last").select("work_id")


@CORE.query(
    "current_sections",
    """SELECT section_id, id AS version_id, effective_from FROM (SELECT *, row_number() OVER (PARTITION BY section_id ORDER BY effective_from DESC, created_at DESC, id DESC) AS rn FROM statute_section_version WHERE effective_from IS NOT NULL) WHERE rn = 1""",
)
def current_sections(spark, sf):
    """The version pointer of each section: the greatest (date, capture, id), aggregated map-side."""
    v = table(spark, sf, "statute_section_version").where("effective_from is not null")
    return v.groupBy("section_id").agg(F.max(F.struct("effective_from", "created_at", "id")).alias("x")).select("section_id", F.col("x.id").alias("version_id"), F.col("x.effective_from").alias("effective_from"))


@CORE.query("archive_paths", "SELECT id, CASE WHEN unreported THEN 'unreported/' ELSE 'reported/' END || left(trim(regexp_replace(lower(trim(court_name)), '[^a-z0-9]+', '-', 'g'), '-'), 80) || '/' || coalesce(CAST(decision_year AS VARCHAR), 'undated') || '/' || left(trim(regexp_replace(lower(trim(canonical_citation)), '[^a-z0-9]+', '-', 'g'), '-'), 80) AS path FROM judgment")
def archive_paths(spark, sf):
    """Where a record is archived: state, court, year and citation, each a safe part of a path."""
    j = table(spark, sf, "judgment")
    return j.select("id", F.concat_ws("/", F.when(F.col("unreported"), "unreported").otherwise("reported"), slug(F.col("court_name")), F.coalesce(F.col("decision_year").cast("string"), F.lit("undated")), slug(F.col("canonical_citation"))).alias("path"))


@CORE.query("query_keys", "SELECT case_id, CASE WHEN length(k) <= 500 THEN k ELSE left(k, 435) || '#' || sha256(k) END AS query_key FROM (SELECT case_id, concat_ws('|', 'reporter=' || nullif(reporter, ''), 'court=' || court) AS k FROM enumerated_case)")
def query_keys(spark, sf):
    """A canonical key of the fields that are set; empty fields do not count."""
    key = F.concat_ws("|", F.concat(F.lit("reporter="), F.nullif("reporter", F.lit(""))), F.concat(F.lit("court="), F.col("court")))
    return table(spark, sf, "enumerated_case").select("case_id", fit_key(key, 500).alias("query_key"))


@CORE.query(
    "title_duplicates",
    """WITH b AS (SELECT id, regexp_replace(lower(case_title), '[^a-z0-9]', '', 'g') AS k, length(coalesce(full_text, '')) AS chars FROM judgment WHERE case_title IS NOT NULL),
    g AS (SELECT *, count(*) OVER (PARTITION BY k) AS members, max(chars) OVER (PARTITION BY k) AS group_best, row_number() OVER (PARTITION BY k ORDER BY chars DESC, id) AS rank FROM b)
    SELECT id, k, rank, chars < floor(group_best * 0.7) AS review FROM g WHERE members > 1""",
)
def title_duplicates(spark, sf):
    """Judgments of the same title ranked for keeping."""
    j = table(spark, sf, "judgment").where("case_title is not null").select("id", F.regexp_replace(F.lower("case_title"), "[^a-z0-9]", "").alias("k"), F.length(F.coalesce("full_text", F.lit(""))).alias("chars"))
    return keeper_ranks(j, ["k"], [F.desc("chars"), "id"], "chars").select("id", "k", "rank", (F.col("chars") < F.floor(F.col("group_best") * 0.7)).alias("review"))


@CORE.query(
    "late_promotions",
    "SELECT source_name, date_trunc('month', created_at) AS month, count(*) AS n, count(*) FILTER (WHERE promoted_at > created_at + INTERVAL 30 DAY) AS late, round(quantile_cont(epoch(promoted_at - created_at) / 3600, 0.9), 3) AS p90_hours FROM judgment WHERE promoted_at IS NOT NULL GROUP BY 1, 2",
)
def late_promotions(spark, sf):
    """Freshness per source and month."""
    j = table(spark, sf, "judgment").where("promoted_at is not null")
    hours = (F.unix_micros(F.col("promoted_at").cast("timestamp")) - F.unix_micros(F.col("created_at").cast("timestamp"))) / 3.6e9
    return j.groupBy("source_name", F.date_trunc("month", "created_at").cast("timestamp_ntz").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("promoted_at") > F.col("created_at") + F.expr("INTERVAL 30 DAY")).alias("late"), F.round(F.percentile(hours, 0.9), 3).alias("p90_hours")
    )


@CORE.query("returned_records", "SELECT d.table_name, count(DISTINCT d.record_id) AS deleted, count(DISTINCT coalesce(j.id, i.id)) AS present FROM deleted_record d LEFT JOIN judgment j ON d.table_name = 'judgment' AND j.id = d.record_id LEFT JOIN instrument i ON d.table_name = 'instrument' AND i.id = d.record_id GROUP BY 1")
def returned_records(spark, sf):
    """Deletions of records that exist all the same."""
    d = table(spark, sf, "deleted_record").select("table_name", "record_id").distinct()
    held = table(spark, sf, "judgment").select(F.lit("judgment").alias("table_name"), F.col("id").alias("record_id")).unionByName(table(spark, sf, "instrument").select(F.lit("instrument").alias("table_name"), F.col("id").alias("record_id"))).withColumn("_held", F.lit(1))
    return d.join(held, ["table_name", "record_id"], "left").groupBy("table_name").agg(F.count(F.lit(1)).alias("deleted"), F.count("_held").alias("present"))


@CORE.query("source_windows", "SELECT id, source_name, lag(id) OVER w AS before, CAST(row_number() OVER w AS INTEGER) AS nth FROM judgment WHERE created_at IS NOT NULL WINDOW w AS (PARTITION BY source_name, decision_year ORDER BY created_at, id)")
def source_windows(spark, sf):
    w = Window.partitionBy("source_name", "decision_year").orderBy("created_at", "id")
    return table(spark, sf, "judgment").where("created_at is not null").select("id", "source_name", F.lag("id").over(w).alias("before"), F.row_number().over(w).alias("nth"))
