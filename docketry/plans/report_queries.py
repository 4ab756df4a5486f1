"""Summaries, coverage, rates, health and top-n reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.operators.timelines import gaps, streak_summary
from docketry.plans.registry import CORE
from docketry.sources.tables import table


@CORE.query(
    "corpus_summary",
    """SELECT count(*) AS judgments, count(*) FILTER (WHERE full_text IS NULL OR trim(full_text) = '') AS empty_bodies, round(100.0 * count(*) FILTER (WHERE full_text IS NULL OR trim(full_text) = '') / count(*), 2) AS empty_pct,
    count(*) FILTER (WHERE unreported) AS unreported, count(*) FILTER (WHERE court_id IS NULL) AS no_court, count(*) FILTER (WHERE decision_date IS NULL) AS no_date, count(DISTINCT source_name) AS sources,
    count(DISTINCT full_text_hash) AS texts, min(decision_date) AS first_date, max(decision_date) AS last_date, round(avg(length(full_text)), 2) AS mean_chars, round(quantile_cont(length(full_text), 0.5), 2) AS median_chars FROM judgment""",
)
def corpus_summary(spark, sf):
    """All counts in one pass."""
    empty = F.col("full_text").isNull() | (F.trim("full_text") == "")
    return table(spark, sf, "judgment").agg(
        F.count(F.lit(1)).alias("judgments"), F.count_if(empty).alias("empty_bodies"), F.round(100.0 * F.count_if(empty) / F.count(F.lit(1)), 2).alias("empty_pct"),
        F.count_if("unreported").alias("unreported"), F.count_if(F.col("court_id").isNull()).alias("no_court"), F.count_if(F.col("decision_date").isNull()).alias("no_date"),
        F.count_distinct("source_name").alias("sources"), F.count_distinct("full_text_hash").alias("texts"), F.min("decision_date").alias("first_date"), F.max("decision_date").alias("last_date"),
        F.round(F.avg(F.length("full_text")), 2).alias("mean_chars"), F.round(F.percentile(F.length("full_text"), 0.5), 2).alias("median_chars"),
    )


@CORE.query("unreported_cube", "SELECT court_name, proceeding_type, CAST(grouping(court_name) AS INTEGER) AS all_courts, CAST(grouping(proceeding_type) AS INTEGER) AS all_types, count(*) AS n FROM judgment WHERE unreported GROUP BY CUBE (court_name, proceeding_type)")
def unreported_cube(spark, sf):
    j = table(spark, sf, "judgment").where("unreported")
    return j.cube("court_name", "proceeding_type").agg(F.grouping("court_name").cast("int").alias("all_courts"), F.grouping("proceeding_type").cast("int").alias("all_types"), F.count(F.lit(1)).alias("n"))


@CORE.query("reporter_year_rollup", "SELECT reporter, decision_year, count(*) AS n FROM judgment GROUP BY ROLLUP (reporter, decision_year)")
def reporter_year_rollup(spark, sf):
    return table(spark, sf, "judgment").rollup("reporter", "decision_year").agg(F.count(F.lit(1)).alias("n"))


@CORE.query("access_grouping_sets", "SELECT access_method, language, count(*) AS n FROM judgment GROUP BY GROUPING SETS ((access_method), (language), ())")
def access_grouping_sets(spark, sf):
    table(spark, sf, "judgment").createOrReplaceTempView("_grouping_source")
    return spark.sql("SELECT access_method, language, count(*) AS n FROM _grouping_source GROUP BY GROUPING SETS ((access_method), (language), ())")


@CORE.query("top_judges", "SELECT judge, count(*) AS n FROM (SELECT unnest(judge_names) AS judge FROM judgment) WHERE judge <> '' GROUP BY 1 ORDER BY n DESC, judge LIMIT 60")
def top_judges(spark, sf):
    """Unnested names by count; a top-k report."""
    names = table(spark, sf, "judgment").select(F.explode("judge_names").alias("judge")).where("judge <> ''")
    return names.groupBy("judge").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "judge").limit(60)


@CORE.query(
    "status_pivot",
    "SELECT user_id % 10 AS shard, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'purchase') AS purchase, count(*) FILTER (WHERE event_type = 'signup') AS signup FROM events GROUP BY 1",
)
def status_pivot(spark, sf):
    """States as columns; the values are stated, so that no pass finds them first."""
    e = table(spark, sf, "events").select((F.col("user_id") % 10).alias("shard"), "event_type")
    states = ["click", "view", "purchase", "signup"]
    p = e.groupBy("shard").pivot("event_type", states).count()
    return p.select("shard", *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in states])


@CORE.query(
    "rate_windows",
    """WITH m AS (SELECT max(ts) AS now FROM events)
    SELECT event_type, count(*) FILTER (WHERE ts >= now - INTERVAL 15 MINUTE) AS last_15m, count(*) FILTER (WHERE ts >= now - INTERVAL 1 HOUR) AS last_1h, count(*) FILTER (WHERE ts >= now - INTERVAL 24 HOUR) AS last_24h,
    round(count(*) FILTER (WHERE ts >= now - INTERVAL 24 HOUR) / 24.0, 1) AS per_hour FROM events, m GROUP BY 1""",
)
def rate_windows(spark, sf):
    """Counts over look-backs from the last event and the hourly rate."""
    e = table(spark, sf, "events").select("event_type", "ts")
    now = e.agg(F.max("ts").alias("now"))
    since = lambda i: F.col("ts") >= F.col("now") - F.expr(f"INTERVAL {i}")
    return e.join(F.broadcast(now), F.lit(True)).groupBy("event_type").agg(
        F.count_if(since("15 MINUTE")).alias("last_15m"), F.count_if(since("1 HOUR")).alias("last_1h"), F.count_if(since("24 HOUR")).alias("last_24h"), F.round(F.count_if(since("24 HOUR")) / 24.0, 1).alias("per_hour")
    )


@CORE.query(
    "latest_capture_classes",
    """WITH l AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at DESC NULLS LAST, page_id DESC) AS rn FROM page_result)
    SELECT CASE WHEN html IS NULL OR html = '' THEN 'empty' WHEN status >= 500 THEN 'server' WHEN status >= 400 THEN 'client' WHEN status IS NULL THEN 'unknown' ELSE 'ok' END AS class, count(*) AS n FROM l WHERE rn = 1 GROUP BY 1""",
)
def latest_capture_classes(spark, sf):
    """The latest capture of each url by class. The latest is an aggregate over a struct, not a sort of the pages."""
    p = table(spark, sf, "page_result").select("url", "fetched_at", "page_id", "status", F.coalesce(F.length("html"), F.lit(0)).alias("chars"))
    last = p.groupBy("url").agg(F.max(F.struct(F.col("fetched_at").isNotNull().alias("has"), "fetched_at", "page_id", "status", "chars")).alias("x")).select("x.*")
    cls = F.when(F.col("chars") == 0, "empty").when(F.col("status") >= 500, "server").when(F.col("status") >= 400, "client").when(F.col("status").isNull(), "unknown").otherwise("ok")
    return last.groupBy(cls.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@CORE.query(
    "queue_health",
    """WITH m AS (SELECT max(queued_at) AS now FROM judgment_upload_work)
    SELECT access_method, count(*) AS queued, count(*) FILTER (WHERE judgment_id IS NULL) AS unlinked, min(queued_at) FILTER (WHERE judgment_id IS NULL) AS oldest_unlinked, max(queued_at) AS newest,
      CASE WHEN max(queued_at) >= max(now) - INTERVAL 6 HOUR THEN 'ok' WHEN max(queued_at) >= max(now) - INTERVAL 18 HOUR THEN 'warn' ELSE 'down' END AS health FROM judgment_upload_work, m GROUP BY 1""",
)
def queue_health(spark, sf):
    """Counts and ages per queue: ok within the limit, warn within three times it, else down."""
    w = table(spark, sf, "judgment_upload_work")
    now = w.agg(F.max("queued_at").alias("now"))
    g = w.join(F.broadcast(now), F.lit(True)).groupBy("access_method").agg(
        F.count(F.lit(1)).alias("queued"), F.count_if(F.col("judgment_id").isNull()).alias("unlinked"), F.min(F.when(F.col("judgment_id").isNull(), F.col("queued_at"))).alias("oldest_unlinked"), F.max("queued_at").alias("newest"), F.max("now").alias("now")
    )
    health = F.when(F.col("newest") >= F.col("now") - F.expr("INTERVAL 6 HOUR"), "ok").when(F.col("newest") >= F.col("now") - F.expr("INTERVAL 18 HOUR"), "warn").otherwise("down")
    return g.select("access_method", "queued", "unlinked", "oldest_unlinked", "newest", health.alias("health"))


@CORE.query(
    "mirror_lag",
    """WITH c AS (SELECT judgment_id, count(*) AS n FROM judgment_upload_work WHERE judgment_id IS NOT NULL GROUP BY 1)
    SELECT source_name, count(*) AS total, count(*) FILTER (WHERE coalesce(n, 0) < 2) AS behind, sum(octet_length(encode(coalesce(full_text, '')))) FILTER (WHERE coalesce(n, 0) < 2) AS bytes_waiting, min(promoted_at) FILTER (WHERE coalesce(n, 0) < 2) AS oldest_waiting
    FROM judgment j LEFT JOIN c ON c.judgment_id = j.id GROUP BY 1""",
)
def mirror_lag(spark, sf):
    """Records with fewer copies than wanted, their bytes and the oldest of them."""
    c = table(spark, sf, "judgment_upload_work").where("judgment_id is not null").groupBy("judgment_id").agg(F.count(F.lit(1)).alias("n"))
    j = table(spark, sf, "judgment").select("id", "source_name", "promoted_at", F.octet_length(F.coalesce("full_text", F.lit(""))).cast("bigint").alias("bytes"))
    j = j.join(c, F.col("id") == F.col("judgment_id"), "left").withColumn("behind", F.coalesce("n", F.lit(0)) < 2)
    return j.groupBy("source_name").agg(F.count(F.lit(1)).alias("total"), F.count_if("behind").alias("behind"), F.sum(F.when(F.col("behind"), F.col("bytes"))).alias("bytes_waiting"), F.min(F.when(F.col("behind"), F.col("promoted_at"))).alias("oldest_waiting"))


@CORE.query(
    "mirror_backlog",
    """WITH c AS (SELECT judgment_id, count(*) AS n FROM judgment_upload_work WHERE judgment_id IS NOT NULL GROUP BY 1)
    SELECT j.id, coalesce(n, 0) AS copies FROM judgment j LEFT JOIN c ON c.judgment_id = j.id WHERE coalesce(n, 0) < 3 ORDER BY promoted_at NULLS FIRST, id LIMIT 100""",
)
def mirror_backlog(spark, sf):
    c = table(spark, sf, "judgment_upload_work").where("judgment_id is not null").groupBy("judgment_id").agg(F.count(F.lit(1)).alias("n"))
    j = table(spark, sf, "judgment").join(c, F.col("id") == F.col("judgment_id"), "left")
    return j.where(F.coalesce("n", F.lit(0)) < 3).orderBy(F.asc_nulls_first("promoted_at"), "id").limit(100).select("id", F.coalesce("n", F.lit(0)).alias("copies"))


@CORE.query(
    "page_continuity_gaps",
    """WITH p AS (SELECT DISTINCT reporter, decision_year, TRY_CAST(regexp_extract(canonical_citation, '([0-9]+)$', 1) AS INTEGER) AS page_no FROM judgment),
    n AS (SELECT reporter, decision_year, page_no AS after, lead(page_no) OVER (PARTITION BY reporter, decision_year ORDER BY page_no) AS before FROM p WHERE page_no IS NOT NULL)
    SELECT * FROM n WHERE before - after > 60""",
)
def page_continuity_gaps(spark, sf):
    j = table(spark, sf, "judgment").select("reporter", "decision_year", F.nullif(F.regexp_extract("canonical_citation", "([0-9]+)$", 1), F.lit("")).try_cast("int").alias("page_no"))
    return gaps(j, ["reporter", "decision_year"], "page_no", 60)


@CORE.query(
    "gap_report",
    """WITH s AS (SELECT reporter, count(*) AS listed FROM enumerated_case WHERE reporter <> '' GROUP BY 1), h AS (SELECT reporter, count(*) AS held FROM judgment GROUP BY 1)
    SELECT reporter, listed, coalesce(held, 0) AS held, greatest(0, listed - coalesce(held, 0)) AS gap FROM s LEFT JOIN h USING (reporter) ORDER BY gap DESC, listed DESC, reporter""",
)
def gap_report(spark, sf):
    s = table(spark, sf, "enumerated_case").where("reporter <> ''").groupBy("reporter").agg(F.count(F.lit(1)).alias("listed"))
    h = table(spark, sf, "judgment").groupBy("reporter").agg(F.count(F.lit(1)).alias("held"))
    held = F.coalesce("held", F.lit(0))
    return s.join(h, "reporter", "left").select("reporter", "listed", held.alias("held"), F.greatest(F.lit(0), F.col("listed") - held).alias("gap")).orderBy(F.desc("gap"), F.desc("listed"), "reporter")


@CORE.query(
    "miss_streaks",
    """WITH m AS (SELECT source_name, (status IS NULL OR status >= 400) AS miss, lag(status IS NULL OR status >= 400, 1, false) OVER w AS was, fetched_at, page_id FROM page_result WINDOW w AS (PARTITION BY source_name ORDER BY fetched_at NULLS FIRST, page_id)),
    n AS (SELECT *, sum(CASE WHEN miss AND NOT was THEN 1 ELSE 0 END) OVER (PARTITION BY source_name ORDER BY fetched_at NULLS FIRST, page_id ROWS UNBOUNDED PRECEDING) AS streak FROM m),
    l AS (SELECT source_name, streak, count(*) AS length FROM n WHERE miss GROUP BY 1, 2)
    SELECT source_name, count(*) AS streaks, max(length) AS longest, max(length) >= 3 AS closed FROM l GROUP BY 1""",
)
def miss_streaks(spark, sf):
    """Runs of failed captures per source, and whether one is long enough to close the source."""
    p = table(spark, sf, "page_result").select("source_name", "fetched_at", "page_id", "status")
    s = streak_summary(p, ["source_name"], F.trunc("fetched_at", "month"), [F.asc_nulls_first("fetched_at"), "page_id"], F.col("status").isNull() | (F.col("status") >= 400))
    return s.select("source_name", "streaks", "longest", (F.col("longest") >= 3).alias("closed"))


@CORE.query(
    "residual_topn",
    """SELECT * FROM (SELECT 'court' AS facet, coalesce(court_name, '(unknown)') AS value, count(*) AS n FROM judgment WHERE decision_date IS NULL OR court_id IS NULL GROUP BY 2 ORDER BY n DESC, value LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'source', coalesce(source_name, '(unknown)') AS value, count(*) AS n FROM judgment WHERE decision_date IS NULL OR court_id IS NULL GROUP BY 2 ORDER BY n DESC, value LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'reporter', coalesce(reporter, '(unknown)') AS value, count(*) AS n FROM judgment WHERE decision_date IS NULL OR court_id IS NULL GROUP BY 2 ORDER BY n DESC, value LIMIT 5)""",
)
def residual_topn(spark, sf):
    j = table(spark, sf, "judgment").where("decision_date is null or court_id is null")
    def top(facet, c):
        return j.groupBy(F.coalesce(c, F.lit("(unknown)")).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(5).select(F.lit(facet).alias("facet"), "value", "n")

    return reduce(DataFrame.unionByName, [top("court", "court_name"), top("source", "source_name"), top("reporter", "reporter")])


@CORE.query(
    "round_robin_sample",
    "SELECT source_name, page_id, rn FROM (SELECT source_name, page_id, row_number() OVER (PARTITION BY source_name ORDER BY page_id) AS rn FROM page_result) ORDER BY rn, source_name LIMIT 20",
)
def round_robin_sample(spark, sf):
    """One row per source in turn. Only the first ``limit`` rows of a source can be sampled, so a source is ranked in its top rows."""
    p = table(spark, sf, "page_result").select("source_name", "page_id")
    ranked = p.withColumn("rn", F.row_number().over(Window.partitionBy("source_name").orderBy("page_id"))).where("rn <= 20")
    return ranked.orderBy("rn", "source_name").limit(20)


@CORE.query("seeded_sample", "SELECT id, md5(id || '|17') AS draw FROM statute_section_version ORDER BY draw, id LIMIT 50")
def seeded_sample(spark, sf):
    """A sample that is the same for the same seed: the smallest hashes."""
    v = table(spark, sf, "statute_section_version").select("id", F.md5(F.concat("id", F.lit("|17"))).alias("draw"))
    return v.orderBy("draw", "id").limit(50)


@CORE.query(
    "preferred_share_batch",
    """WITH r AS (SELECT work_id, access_method = 'import_folder' AS preferred, row_number() OVER (PARTITION BY access_method = 'import_folder' ORDER BY queued_at NULLS LAST, work_id) AS rn FROM judgment_upload_work),
    p AS (SELECT * FROM r WHERE preferred AND rn <= 40) SELECT work_id, preferred FROM p UNION ALL SELECT work_id, preferred FROM r WHERE NOT preferred AND rn <= 100 - (SELECT count(*) FROM p)""",
)
def preferred_share_batch(spark, sf):
    """A batch with a reserved share for one source and the rest oldest first."""
    w = table(spark, sf, "judgment_upload_work").where("access_method is not null")
    pref = w.where("access_method = 'import_folder'").orderBy(F.asc_nulls_last("queued_at"), "work_id").limit(40).select("work_id", F.lit(True).alias("preferred"))
    rest = w.where("access_method <> 'import_folder'").orderBy(F.asc_nulls_last("queued_at"), "work_id").limit(100).select("work_id", F.lit(False).alias("preferred"), "queued_at")
    rank = rest.withColumn("rn", F.row_number().over(Window.partitionBy("preferred").orderBy(F.asc_nulls_last("queued_at"), "work_id")))
    left = pref.agg((100 - F.count(F.lit(1))).alias("room"))
    return pref.unionByName(rank.join(F.broadcast(left), F.col("rn") <= F.col("room")).select("work_id", "preferred"))


@CORE.query(
    "statute_stub_report",
    """WITH v AS (SELECT statute_id, count(DISTINCT section_id) AS sections, count(*) FILTER (WHERE length(trim(section_text)) > 0) AS with_text FROM statute_section_version GROUP BY 1)
    SELECT count(*) AS statutes, count(*) FILTER (WHERE coalesce(sections, 0) = 0) AS no_sections, count(*) FILTER (WHERE sections > 0 AND with_text > 0) AS complete, count(*) FILTER (WHERE year_enacted IS NULL) AS no_year,
      count(*) FILTER (WHERE canonical_name_key IS NULL) AS no_key, count(*) FILTER (WHERE NOT regexp_matches(name, 'Act|Ordinance|Order|Rules|Regulations|Code')) AS no_legislative_word FROM statute s LEFT JOIN v ON v.statute_id = s.id""",
)
def statute_stub_report(spark, sf):
    v = table(spark, sf, "statute_section_version").groupBy("statute_id").agg(F.count_distinct("section_id").alias("sections"), F.count_if(F.length(F.trim("section_text")) > 0).alias("with_text"))
    s = table(spark, sf, "statute")
    return s.join(v, s["id"] == v["statute_id"], "left").agg(
        F.count(F.lit(1)).alias("statutes"), F.count_if(F.coalesce("sections", F.lit(0)) == 0).alias("no_sections"), F.count_if((F.col("sections") > 0) & (F.col("with_text") > 0)).alias("complete"),
        F.count_if(F.col("year_enacted").isNull()).alias("no_year"), F.count_if(F.col("canonical_name_key").isNull()).alias("no_key"), F.count_if(~F.col("name").rlike("Act|Ordinance|Order|Rules|Regulations|Code")).alias("no_legislative_word"),
    )


@CORE.query("progress_by_source", "SELECT source_name, count(*) AS total, count(*) FILTER (WHERE html <> '') AS done, round(100.0 * count(*) FILTER (WHERE html <> '') / count(*), 1) AS pct, count(*) FILTER (WHERE html IS NULL OR html = '') AS pending FROM page_result GROUP BY 1")
def progress_by_source(spark, sf):
    p = table(spark, sf, "page_result").select("source_name", (F.coalesce(F.length("html"), F.lit(0)) > 0).alias("done"))
    return p.groupBy("source_name").agg(F.count(F.lit(1)).alias("total"), F.count_if("done").alias("done"), F.round(100.0 * F.count_if("done") / F.count(F.lit(1)), 1).alias("pct"), F.count_if(~F.col("done")).alias("pending"))


@CORE.query("visible_null_year", "SELECT id, name FROM statute WHERE year_enacted IS NULL AND NOT is_repealed ORDER BY name LIMIT 100")
def visible_null_year(spark, sf):
    return table(spark, sf, "statute").where("year_enacted is null and not is_repealed").orderBy("name").limit(100).select("id", "name")


@CORE.query("daily_budget", "SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS used, sum(count(*)) OVER (PARTITION BY user_id, date_trunc('month', CAST(ts AS DATE)) ORDER BY CAST(ts AS DATE)) AS month_used, count(*) > 5 AS over_day FROM events GROUP BY CAST(ts AS DATE), user_id, date_trunc('month', CAST(ts AS DATE))")
def daily_budget(spark, sf):
    """Use per day with the running use of the month, and whether the day's budget is spent."""
    d = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("used"))
    w = Window.partitionBy("user_id", F.trunc("day", "month")).orderBy("day")
    return d.select("day", "user_id", "used", F.sum("used").over(w).alias("month_used"), (F.col("used") > 5).alias("over_day"))
