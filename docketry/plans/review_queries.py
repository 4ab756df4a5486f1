"""Reviews: marks and their undoing, names that differ by a slip, sources that have come to a stop."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.operators.quarantine import apply_marks, undo_marks
from docketry.plans.registry import CORE
from docketry.sources.tables import table

_STATES = "SELECT page_id, CASE WHEN status IS NULL THEN NULL WHEN status >= 400 THEN 'failed' ELSE 'open' END AS state, coalesce(html, '') = '' AS bad FROM page_result"


def _states(spark, sf):
    state = F.when(F.col("status").isNull(), F.lit(None)).when(F.col("status") >= 400, "failed").otherwise("open")
    p = table(spark, sf, "page_result").select("page_id", state.alias("state"), (F.coalesce(F.length("html"), F.lit(0)) == 0).alias("bad"))
    return p.select("page_id", "state"), p.where("bad").select("page_id")


@CORE.query("quarantine_applied", f"SELECT CASE WHEN bad THEN 'quarantined' ELSE state END AS state, count(*) AS n FROM ({_STATES}) GROUP BY 1")
def quarantine_applied(spark, sf):
    """Captures by state once those without content are taken out of service."""
    after, _ = apply_marks(*_marks(spark, sf))
    return after.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def _marks(spark, sf):
    records, bad = _states(spark, sf)
    return records, "page_id", bad, "state", "quarantined"


@CORE.query("quarantine_undone", f"SELECT page_id, state FROM ({_STATES})")
def quarantine_undone(spark, sf):
    """The same captures after the marks were taken back: every state is what it was."""
    after, before = apply_marks(*_marks(spark, sf))
    return undo_marks(after, "page_id", before, "state")


@CORE.query("near_names", "SELECT i.id, levenshtein(lower(i.affected_statute_name), lower(s.name)) AS edits FROM instrument i JOIN statute s ON s.id = i.affected_statute_id WHERE levenshtein(lower(i.affected_statute_name), lower(s.name)) <= 2")
def near_names(spark, sf):
    """Names that instruments give their statutes within two edits; the distance stops at the bound."""
    s = table(spark, sf, "statute").select(F.col("id").alias("affected_statute_id"), "name")
    edits = F.levenshtein(F.lower("affected_statute_name"), F.lower("name"), 2)
    return table(spark, sf, "instrument").join(s, "affected_statute_id").select("id", edits.alias("edits")).where("edits >= 0")


@CORE.query(
    "stalled_sources",
    """WITH m AS (SELECT max(fetched_at) AS now FROM page_result), s AS (SELECT source_name, max(fetched_at) AS last_at, count(*) FILTER (WHERE coalesce(html, '') = '') AS pending FROM page_result GROUP BY 1)
    SELECT source_name, last_at, pending, pending > 0 AND last_at < now - INTERVAL 7 DAY AS stalled FROM s, m""",
)
def stalled_sources(spark, sf):
    """Sources that have something pending and have captured nothing for a week before the last capture of all."""
    g = table(spark, sf, "page_result").groupBy("source_name").agg(F.max("fetched_at").alias("last_at"), F.count_if(F.coalesce(F.length("html"), F.lit(0)) == 0).alias("pending"))
    now = g.agg(F.max("last_at").alias("now"))
    return g.join(F.broadcast(now), F.lit(True)).select("source_name", "last_at", "pending", ((F.col("pending") > 0) & (F.col("last_at") < F.col("now") - F.expr("INTERVAL 7 DAY"))).alias("stalled"))


@CORE.query(
    "name_conflicts",
    r"""WITH t AS (SELECT id, jurisdiction, list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(name), '[^a-z]+', ' ', 'g')), ' '), lambda w: length(w) >= 4))) AS w FROM statute WHERE name IS NOT NULL),
    p AS (SELECT a.id AS a, b.id AS b, len(list_intersect(a.w, b.w)) AS shared, len(list_distinct(a.w || b.w)) AS whole FROM t a JOIN t b ON a.jurisdiction = b.jurisdiction AND a.id < b.id)
    SELECT a AS id_a, b AS id_b, round(shared / whole, 4) AS alike FROM p WHERE shared >= 0.75 * whole AND whole > 0""",
)
def name_conflicts(spark, sf):
    """Statutes of one jurisdiction whose names share three quarters of their words; a table of fixed size, joined by the words they share."""
    words = F.array_distinct(F.filter(F.split(F.trim(F.regexp_replace(F.lower("name"), "[^a-z]+", " ")), " "), lambda w: F.length(w) >= 4))
    t = table(spark, sf, "statute").where("name is not null").select("id", "jurisdiction", words.alias("w")).withColumn("n", F.size("w"))
    e = t.select("id", "jurisdiction", "n", F.explode("w").alias("word"))
    a = e.select(F.col("id").alias("id_a"), F.col("n").alias("na"), "jurisdiction", "word")
    b = e.select(F.col("id").alias("id_b"), F.col("n").alias("nb"), "jurisdiction", "word")
    both = a.join(b, ["jurisdiction", "word"]).where("id_a < id_b").groupBy("id_a", "id_b", "na", "nb").agg(F.count(F.lit(1)).alias("both"))
    any_ = F.col("na") + F.col("nb") - F.col("both")
    return both.where(F.col("both") >= 0.75 * any_).select("id_a", "id_b", F.round(F.col("both") / any_, 4).alias("alike"))
