"""Search, lookups, listings and exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.functions import text as T
from docketry.functions.citations import citation_key, key_sql
from docketry.operators.identity import resolve_unique
from docketry.operators.visibility import page, quarantined, servable
from docketry.plans.registry import CORE
from docketry.sources.tables import table


def _deleted(spark, sf, name):
    return table(spark, sf, "deleted_record").where(F.col("table_name") == name)


WORDS = ["notice", "served", "stranger"]
_SERVABLE = "NOT EXISTS (SELECT 1 FROM deleted_record d WHERE d.table_name = 'judgment' AND d.record_id = j.id)"


@CORE.query(
    "search_judgments",
    f"""SELECT id, canonical_citation, case_title, court_name, decision_year,
      (CASE WHEN b > 1 THEN '…' ELSE '' END) || substring(full_text, b, 300) || (CASE WHEN length(full_text) >= b + 300 THEN '…' ELSE '' END) AS snippet
    FROM (SELECT *, greatest(coalesce(least(nullif(instr(lower(full_text), 'notice'), 0), nullif(instr(lower(full_text), 'served'), 0), nullif(instr(lower(full_text), 'stranger'), 0)), 1) - 100, 1) AS b
          FROM judgment j WHERE contains(lower(concat_ws(' ', canonical_citation, case_title, court_name, full_text)), 'notice')
          AND contains(lower(concat_ws(' ', canonical_citation, case_title, court_name, full_text)), 'served')
          AND contains(lower(concat_ws(' ', canonical_citation, case_title, court_name, full_text)), 'stranger')
          AND decision_year BETWEEN 1960 AND 2010 AND {_SERVABLE})
    ORDER BY decision_year DESC NULLS LAST, decision_date DESC NULLS LAST, canonical_citation LIMIT 20""",
)
def search_judgments(spark: SparkSession, sf: str) -> DataFrame:
    """Judgments with every word, in a range of years, not withdrawn, newest first, with a snippet."""
    j = servable(table(spark, sf, "judgment"), "id", _deleted(spark, sf, "judgment"), "record_id")
    hay = F.concat_ws(" ", "canonical_citation", "case_title", "court_name", "full_text")
    hits = j.where(F.col("decision_year").between(1960, 2010) & T.contains_all(hay, WORDS))
    top = hits.orderBy(F.desc_nulls_last("decision_year"), F.desc_nulls_last("decision_date"), "canonical_citation").limit(20)
    return top.select("id", "canonical_citation", "case_title", "court_name", "decision_year", T.snippet(F.col("full_text"), WORDS).alias("snippet"))


@CORE.query("servable_judgments", f"SELECT id, reporter FROM judgment j WHERE {_SERVABLE}")
def servable_judgments(spark, sf):
    return servable(table(spark, sf, "judgment").select("id", "reporter"), "id", _deleted(spark, sf, "judgment"), "record_id")


@CORE.query("quarantined_judgments", f"SELECT id, reporter FROM judgment j WHERE NOT ({_SERVABLE})")
def quarantined_judgments(spark, sf):
    return quarantined(table(spark, sf, "judgment").select("id", "reporter"), "id", _deleted(spark, sf, "judgment"), "record_id")


@CORE.query(
    "list_judgments_page",
    "SELECT id, case_title, proceeding_type, length(trim(coalesce(full_text, ''))) > 0 AS has_body, count(*) OVER () AS total FROM judgment WHERE source_name LIKE '%statutes%' AND proceeding_type = 'bail' AND NOT unreported ORDER BY decision_date DESC NULLS LAST, id LIMIT 25 OFFSET 10",
)
def list_judgments_page(spark, sf):
    """Optional filters folded into one predicate, the total beside the page."""
    j = table(spark, sf, "judgment")
    filters = [F.contains("source_name", F.lit("statutes")), F.col("proceeding_type") == "bail", ~F.col("unreported")]
    hits = j.where(reduce(lambda a, b: a & b, filters)).select("id", "case_title", "proceeding_type", "decision_date", T.has_body(F.col("full_text")).alias("has_body"))
    total = hits.agg(F.count(F.lit(1)).alias("total"))
    rows = page(hits, [F.desc_nulls_last("decision_date"), "id"], 25, 10)
    return rows.join(F.broadcast(total), F.lit(True)).select("id", "case_title", "proceeding_type", "has_body", "total")


@CORE.query(
    "list_statutes",
    "SELECT s.id, s.name, s.year_enacted, count(v.id) AS captures, count(DISTINCT v.section_id) AS sections, coalesce(sum(length(v.section_text)), 0) AS chars FROM statute s LEFT JOIN statute_section_version v ON v.statute_id = s.id GROUP BY ALL HAVING count(DISTINCT v.section_id) >= 2 ORDER BY s.name",
)
def list_statutes(spark, sf):
    """Statutes with grouped statistics of their sections, filtered on the aggregate. The sections are aggregated before the join."""
    v = table(spark, sf, "statute_section_version").groupBy("statute_id").agg(F.count("id").alias("captures"), F.count_distinct("section_id").alias("sections"), F.sum(F.length("section_text")).alias("chars"))
    s = table(spark, sf, "statute")
    joined = s.join(v, s["id"] == v["statute_id"], "left")
    return joined.select("id", "name", "year_enacted", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("captures", "sections", "chars")]).where("sections >= 2").orderBy("name")


@CORE.query(
    "list_citations",
    "SELECT case_id, citation, title, reporter FROM enumerated_case WHERE (citation ILIKE '%lahore%' OR title ILIKE '%state%') AND reporter = 'PLD' ORDER BY citation, case_id LIMIT 50 OFFSET 5",
)
def list_citations(spark, sf):
    e = table(spark, sf, "enumerated_case")
    hits = e.where((F.col("citation").ilike("%lahore%") | F.col("title").ilike("%state%")) & (F.col("reporter") == "PLD"))
    return page(hits.select("case_id", "citation", "title", "reporter"), ["citation", "case_id"], 50, 5)


@CORE.query(
    "get_statute_sections",
    """WITH cur AS (SELECT *, row_number() OVER (PARTITION BY statute_id, section_number ORDER BY effective_from DESC NULLS LAST, created_at DESC, id DESC) AS rn FROM statute_section_version)
    SELECT s.name, c.section_number, c.effective_from, length(c.section_text) AS chars FROM statute s JOIN cur c ON c.statute_id = s.id AND c.rn = 1
    WHERE s.id = (SELECT statute_id FROM statute_section_version GROUP BY statute_id ORDER BY count(*) DESC, statute_id LIMIT 1)""",
)
def get_statute_sections(spark, sf):
    """The current version of each section of the statute with most captures."""
    v = table(spark, sf, "statute_section_version")
    busiest = v.groupBy("statute_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "statute_id").limit(1).select("statute_id")
    mine = v.join(F.broadcast(busiest), "statute_id", "left_semi")
    rank = F.max(F.struct(F.col("effective_from").isNotNull().alias("has"), "effective_from", "created_at", "id", F.length("section_text").alias("chars")))
    cur = mine.groupBy("statute_id", "section_number").agg(rank.alias("c"))
    s = table(spark, sf, "statute").select(F.col("id").alias("statute_id"), "name")
    return cur.join(s, "statute_id").select("name", "section_number", F.col("c.effective_from").alias("effective_from"), F.col("c.chars").alias("chars"))


@CORE.query(
    "verify_citations",
    f"""WITH e AS (SELECT case_id, {key_sql('citation')} AS key, list_sort(list_distinct(list_filter(list_transform(coalesce(parallel_citations, []), lambda x: {key_sql('x')}), lambda k: k IS NOT NULL))) AS alternates FROM enumerated_case),
    h AS (SELECT {key_sql('canonical_citation')} AS key, min(id) AS judgment_id FROM judgment GROUP BY 1)
    SELECT case_id, e.key, alternates, judgment_id, judgment_id IS NOT NULL AS found FROM e LEFT JOIN h ON h.key = e.key WHERE e.key IS NOT NULL""",
)
def verify_citations(spark, sf):
    """For every listed citation whether a judgment is held under it, with the alternates that are listed beside it."""
    e = table(spark, sf, "enumerated_case").select("case_id", citation_key(F.col("citation")).alias("key"), F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce("parallel_citations", F.array().cast("array<string>")), citation_key), lambda k: k.isNotNull()))).alias("alternates"))
    held = table(spark, sf, "judgment").select(citation_key(F.col("canonical_citation")).alias("key"), F.col("id").alias("judgment_id")).where("key is not null")
    held = held.groupBy("key").agg(F.min("judgment_id").alias("judgment_id"))
    return e.where("key is not null").join(held, "key", "left").select("case_id", "key", "alternates", "judgment_id", F.col("judgment_id").isNotNull().alias("found"))


@CORE.query(
    "resolve_work_judgments",
    """WITH t AS (SELECT lower(id) AS k, id FROM judgment UNION ALL SELECT full_text_hash, id FROM judgment WHERE full_text_hash IS NOT NULL),
    h AS (SELECT k, min(id) AS low, max(id) AS high FROM t GROUP BY k),
    r AS (SELECT work_id, lower(trim(judgment_id)) AS judgment_key FROM judgment_upload_work)
    SELECT r.work_id, r.judgment_key, CASE WHEN low = high THEN low END AS resolved_id, CASE WHEN low IS NULL THEN 'unresolved' WHEN low = high THEN 'linked' ELSE 'ambiguous' END AS resolution
    FROM r LEFT JOIN h ON h.k = r.judgment_key""",
)
def resolve_work_judgments(spark, sf):
    """Each queued work with the one judgment its key names under either of two key columns."""
    refs = table(spark, sf, "judgment_upload_work").select("work_id", F.lower(F.trim("judgment_id")).alias("judgment_key"))
    targets = table(spark, sf, "judgment").select("id", F.lower("id").alias("lower_id"), "full_text_hash")
    return resolve_unique(refs, "judgment_key", targets, ["lower_id", "full_text_hash"], "id")


@CORE.query(
    "statute_by_words",
    "SELECT id, name FROM statute WHERE contains(lower(name), 'southmark') AND contains(lower(name), 'act') ORDER BY length(name), name LIMIT 1",
)
def statute_by_words(spark, sf):
    """The shortest name that has all words."""
    s = table(spark, sf, "statute").where(T.contains_all(F.col("name"), ["southmark", "act"]))
    return s.orderBy(F.length("name"), "name").limit(1).select("id", "name")


@CORE.query(
    "export_judgments",
    "SELECT id, canonical_citation, decision_year, CASE WHEN access_method = 'login_session' THEN '[restricted]' ELSE full_text END AS full_text FROM judgment ORDER BY decision_year DESC NULLS LAST, canonical_citation LIMIT 200",
)
def export_judgments(spark, sf):
    """Rows for export with restricted texts masked."""
    j = table(spark, sf, "judgment").orderBy(F.desc_nulls_last("decision_year"), "canonical_citation").limit(200)
    return j.select("id", "canonical_citation", "decision_year", F.when(F.col("access_method") == "login_session", "[restricted]").otherwise(F.col("full_text")).alias("full_text"))


@CORE.query(
    "record_violations",
    """SELECT id, list_filter([CASE WHEN canonical_citation IS NULL OR canonical_citation = '' THEN 'citation' END, CASE WHEN decision_year NOT BETWEEN 1947 AND 2100 THEN 'year' END,
      CASE WHEN confidence_score NOT BETWEEN 0 AND 1 THEN 'confidence' END, CASE WHEN bench_type NOT IN ('single','division','full','larger') THEN 'bench_type' END,
      CASE WHEN length(trim(coalesce(full_text, ''))) < 200 THEN 'thin' END, CASE WHEN court_id IS NULL THEN 'court' END, CASE WHEN sha256(full_text) <> full_text_hash THEN 'hash' END], lambda x: x IS NOT NULL) AS violations FROM judgment""",
)
def record_violations(spark, sf):
    """The rules that each record breaks; an empty list is a sound record."""
    rules = [
        ("citation", F.col("canonical_citation").isNull() | (F.col("canonical_citation") == "")),
        ("year", ~F.col("decision_year").between(1947, 2100)),
        ("confidence", ~F.col("confidence_score").between(0, 1)),
        ("bench_type", ~F.col("bench_type").isin("single", "division", "full", "larger")),
        ("thin", T.text_is_thin(F.col("full_text"))),
        ("court", F.col("court_id").isNull()),
        ("hash", T.sha256_text(F.col("full_text")) != F.col("full_text_hash")),
    ]
    return table(spark, sf, "judgment").select("id", F.array_compact(F.array(*[F.when(c, n) for n, c in rules])).alias("violations"))


@CORE.query("json_records", "SELECT id, '1' AS schema_version, coalesce(case_title, '') AS title, coalesce(reporter, '') AS reporter FROM judgment")
def json_records(spark, sf):
    """Versioned JSON records, written and read back."""
    j = table(spark, sf, "judgment").select("id", F.to_json(F.struct(F.lit(1).alias("schema_version"), "id", F.coalesce("case_title", F.lit("")).alias("title"), F.coalesce("reporter", F.lit("")).alias("reporter"), "judge_names")).alias("record"))
    field = lambda n: F.get_json_object("record", f"$.{n}")
    return j.select("id", field("schema_version").alias("schema_version"), field("title").alias("title"), field("reporter").alias("reporter"))


@CORE.query(
    "key_violations",
    """SELECT 'judgment.canonical_citation' AS rule, count(*) AS n FROM (SELECT canonical_citation FROM judgment GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'judgment.identity', count(*) FROM (SELECT 1 FROM judgment WHERE court_id IS NOT NULL AND decision_date IS NOT NULL AND full_text_hash IS NOT NULL GROUP BY court_id, docket_key, decision_date, full_text_hash, unreported HAVING count(*) > 1)
    UNION ALL SELECT 'statute.name', count(*) FROM (SELECT name FROM statute GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'section.text_hash', count(*) FROM (SELECT 1 FROM statute_section_version GROUP BY section_id, text_hash HAVING count(*) > 1)
    UNION ALL SELECT 'instrument.full_text_hash', count(*) FROM (SELECT full_text_hash FROM instrument GROUP BY 1 HAVING count(*) > 1)""",
)
def key_violations(spark, sf):
    """Declared unique keys with the number of values that break them."""
    def broken(rule, df, *keys):
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")

    j, v = table(spark, sf, "judgment"), table(spark, sf, "statute_section_version")
    whole = j.where("court_id is not null and decision_date is not null and full_text_hash is not null")
    parts = [
        broken("judgment.canonical_citation", j, "canonical_citation"),
        broken("judgment.identity", whole, "court_id", "docket_key", "decision_date", "full_text_hash", "unreported"),
        broken("statute.name", table(spark, sf, "statute"), "name"),
        broken("section.text_hash", v, "section_id", "text_hash"),
        broken("instrument.full_text_hash", table(spark, sf, "instrument"), "full_text_hash"),
    ]
    return reduce(DataFrame.unionByName, parts)


@CORE.query(
    "court_mismatches",
    """WITH c AS (SELECT court_id, min(court_name) AS usual FROM (SELECT court_id, court_name, count(*) AS n, row_number() OVER (PARTITION BY court_id ORDER BY count(*) DESC, court_name) AS rn FROM judgment WHERE court_id IS NOT NULL GROUP BY 1, 2) WHERE rn = 1 GROUP BY 1)
    SELECT j.id, j.court_name, c.usual FROM judgment j LEFT JOIN c USING (court_id) WHERE c.usual IS NULL OR lower(trim(regexp_replace(j.court_name, '\\s+', ' ', 'g'))) <> lower(trim(regexp_replace(c.usual, '\\s+', ' ', 'g')))""",
)
def court_mismatches(spark, sf):
    """Judgments whose court's name is not the usual one of its court id."""
    j = table(spark, sf, "judgment")
    counts = j.where("court_id is not null").groupBy("court_id", "court_name").agg(F.count(F.lit(1)).alias("n"))
    usual = counts.withColumn("rn", F.row_number().over(Window.partitionBy("court_id").orderBy(F.desc("n"), "court_name"))).where("rn = 1").select("court_id", F.col("court_name").alias("usual"))
    fold = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return j.join(usual, "court_id", "left").where(F.col("usual").isNull() | (fold("court_name") != fold("usual"))).select("id", "court_name", "usual")


@CORE.query(
    "known_new_partition",
    "SELECT case_id, EXISTS (SELECT 1 FROM judgment j WHERE j.canonical_citation = e.citation) AS known FROM enumerated_case e",
)
def known_new_partition(spark, sf):
    """Listed rows split into known and new by membership of their citation."""
    e = table(spark, sf, "enumerated_case").select("case_id", "citation")
    held = table(spark, sf, "judgment").select(F.col("canonical_citation").alias("citation"), F.lit(True).alias("known")).where("citation is not null").distinct()
    return e.join(held, "citation", "left").select("case_id", F.coalesce("known", F.lit(False)).alias("known"))


@CORE.query(
    "children_of_parents",
    "SELECT target_id, count(*) AS queued, count(DISTINCT judgment_id) AS judgments FROM judgment_upload_work w WHERE EXISTS (SELECT 1 FROM judgment_upload_work o WHERE o.target_id = w.target_id AND o.work_id <> w.work_id) GROUP BY 1",
)
def children_of_parents(spark, sf):
    """Targets that were queued more than once: a self-EXISTS as a grouped filter."""
    return table(spark, sf, "judgment_upload_work").where("target_id is not null").groupBy("target_id").agg(F.count(F.lit(1)).alias("queued"), F.count_distinct("judgment_id").alias("judgments")).where("queued > 1")


@CORE.query("reader_columns", "SELECT id, canonical_citation, case_title, court_name FROM judgment WHERE unreported")
def reader_columns(spark, sf):
    """The columns a reader may see: an allow-list against the schema."""
    allowed = ["id", "canonical_citation", "case_title", "court_name", "no_such_column"]
    j = table(spark, sf, "judgment").where("unreported")
    return j.select(*[c for c in allowed if c in j.columns])
