"""Extraction from texts and rule classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.functions import dates as D
from docketry.functions import legal as L
from docketry.functions import text as T
from docketry.functions.citations import citation_key, key_sql
from docketry.operators.identity import resolve_unique
from docketry.operators.sections import carry_forward_merge, fuller_text_wins, is_fake_number, reextract_gate, split_sections
from docketry.plans.registry import CORE
from docketry.sources.tables import table


@CORE.query("citation_keys", f"SELECT id, canonical_citation, {key_sql('canonical_citation')} AS k FROM judgment")
def citation_keys(spark, sf):
    """Keys of the canonical citations of all judgments, of every reporter; null where a judgment has no sound citation."""
    return table(spark, sf, "judgment").select("id", "canonical_citation", citation_key(F.col("canonical_citation")).alias("k"))


@CORE.query("citation_mentions", f"SELECT id, unnest(list_distinct(regexp_extract_all(full_text, '{L.CITATION_MENTION}', 1))) AS citation FROM judgment")
def citation_mentions(spark, sf):
    return table(spark, sf, "judgment").select("id", F.explode(L.mentions(F.col("full_text"), L.CITATION_MENTION)).alias("citation"))


@CORE.query("statute_mentions", f"SELECT act, count(*) AS judgments FROM (SELECT id, unnest(list_distinct(regexp_extract_all(full_text, '{L.ACT_MENTION}', 1))) AS act FROM judgment) GROUP BY 1")
def statute_mentions(spark, sf):
    j = table(spark, sf, "judgment").select("id", F.explode(L.mentions(F.col("full_text"), L.ACT_MENTION)).alias("act"))
    return j.groupBy("act").agg(F.count(F.lit(1)).alias("judgments"))


@CORE.query("section_mentions", f"SELECT id, len(regexp_extract_all(section_text, '{L.SECTION_MENTION}', 1)) AS mentions, list_sort(list_distinct(regexp_extract_all(section_text, '{L.SECTION_MENTION}', 1))) AS sections FROM statute_section_version WHERE section_text IS NOT NULL")
def section_mentions(spark, sf):
    v = table(spark, sf, "statute_section_version").where("section_text is not null")
    found = F.regexp_extract_all("section_text", F.lit(L.SECTION_MENTION), F.lit(1))
    return v.select("id", F.size(found).alias("mentions"), F.array_sort(F.array_distinct(found)).alias("sections"))


@CORE.query(
    "judgment_dates",
    f"""WITH t AS (SELECT id, full_text FROM judgment WHERE full_text IS NOT NULL),
    d AS (SELECT id, TRY_CAST(try_strptime(regexp_replace(unnest(regexp_extract_all(full_text, '{D.DAY_FIRST}')), ',', ''), '%d %B %Y') AS DATE) AS day FROM t
      UNION ALL SELECT id, TRY_CAST(try_strptime(unnest(regexp_extract_all(full_text, '{D.MONTH_FIRST}')), '%B %d, %Y') AS DATE) FROM t
      UNION ALL SELECT id, TRY_CAST(try_strptime(regexp_replace(unnest(regexp_extract_all(full_text, '{D.NUMERIC}')), '[/-]', '.', 'g'), '%d.%m.%Y') AS DATE) FROM t
      UNION ALL SELECT id, TRY_CAST(try_strptime(unnest(regexp_extract_all(full_text, '{D.ISO}')), '%Y-%m-%d') AS DATE) FROM t)
    SELECT id, count(DISTINCT day) AS dates, min(day) AS first_date, max(day) AS last_date FROM d WHERE day BETWEEN DATE '1947-01-01' AND DATE '2100-12-31' GROUP BY 1""",
)
def judgment_dates(spark, sf):
    j = table(spark, sf, "judgment").select("id", D.find_dates(F.col("full_text")).alias("d")).where(F.size("d") > 0)
    return j.select("id", F.size("d").cast("bigint").alias("dates"), F.array_min("d").alias("first_date"), F.array_max("d").alias("last_date"))


@CORE.query("decision_date_evidence", "SELECT id, contains(full_text, ltrim(strftime(decision_date, '%d'), '0') || strftime(decision_date, ' %B %Y')) AS evidenced FROM judgment WHERE decision_date IS NOT NULL AND full_text IS NOT NULL")
def decision_date_evidence(spark, sf):
    """Whether the stored date stands in the text."""
    j = table(spark, sf, "judgment").where("decision_date is not null and full_text is not null")
    return j.select("id", F.contains("full_text", F.date_format("decision_date", "d MMMM yyyy")).alias("evidenced"))


@CORE.query("hearing_dates", "SELECT id, CAST(try_strptime(regexp_extract(full_text, 'Date of hearing: ([0-9]{1,2} [A-Za-z]+ [0-9]{4})', 1), '%d %B %Y') AS DATE) AS hearing FROM judgment WHERE regexp_matches(full_text, 'Date of hearing: [0-9]{1,2} [A-Z][a-z]+ [0-9]{4}')")
def hearing_dates(spark, sf):
    """The date that follows a hint."""
    j = table(spark, sf, "judgment").where(F.col("full_text").rlike("Date of hearing: [0-9]{1,2} [A-Z][a-z]+ [0-9]{4}"))
    return j.select("id", F.try_to_timestamp(F.regexp_extract("full_text", "Date of hearing: ([0-9]{1,2} [A-Za-z]+ [0-9]{4})", 1), F.lit("d MMMM yyyy")).cast("date").alias("hearing"))


@CORE.query(
    "title_parties",
    "SELECT id, trim(regexp_extract(case_title, '(?i)^(.*?) (?:v\\.|vs\\.?|versus) (.*)$', 1)) AS petitioner, trim(regexp_extract(case_title, '(?i)^(.*?) (?:v\\.|vs\\.?|versus) (.*)$', 2)) AS respondent FROM judgment WHERE case_title IS NOT NULL",
)
def title_parties(spark, sf):
    pattern = r"(?i)^(.*?) (?:v\.|vs\.?|versus) (.*)$"
    j = table(spark, sf, "judgment").where("case_title is not null")
    return j.select("id", F.trim(F.regexp_extract("case_title", pattern, 1)).alias("petitioner"), F.trim(F.regexp_extract("case_title", pattern, 2)).alias("respondent"))


def _rules_sql(column: str) -> str:
    bare = f"regexp_replace(lower(trim(regexp_replace(replace(coalesce({column}, ''), chr(160), ' '), '\\s+', ' ', 'g'))), '{L._PROCEDURE_CODE}', ' ', 'g')"
    return "CASE " + " ".join(f"WHEN regexp_matches({bare}, '{p}') THEN '{n}'" for n, p in L.rules(L.PROCEEDINGS)) + " ELSE 'other' END"


@CORE.query("proceeding_types", f"SELECT id, CASE WHEN k <> 'other' THEN k ELSE {_rules_sql('left(full_text, 1500)')} END AS kind FROM (SELECT id, full_text, {_rules_sql('docket_number')} AS k FROM judgment)")
def proceeding_types(spark, sf):
    """The kind of each proceeding by its number, else by the heading, which is the first 1,500 characters of its text."""
    return table(spark, sf, "judgment").select("id", L.proceeding_type(F.col("docket_number"), F.left("full_text", F.lit(1500))).alias("kind"))


def _treatment_sql(column: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{pattern}') THEN '{label}' " for label, pattern, _ in L.treatment_rules()) + "END"


@CORE.query("treatments", f"SELECT {_treatment_sql('full_text')} AS label, count(*) AS n FROM judgment GROUP BY 1")
def treatments(spark, sf):
    """The surest treatment that a text speaks of."""
    return table(spark, sf, "judgment").select(L.best_treatment(F.col("full_text")).getField("label").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@CORE.query("bench_checks", "SELECT id, len(list_filter(judge_names, lambda x: length(x) > 3)) AS judges, CASE WHEN bench_size = 1 THEN 'single' WHEN bench_size = 2 THEN 'division' WHEN bench_size BETWEEN 3 AND 5 THEN 'full' WHEN bench_size > 5 THEN 'larger' END AS by_size, bench_type FROM judgment WHERE judge_names IS NOT NULL")
def bench_checks(spark, sf):
    j = table(spark, sf, "judgment").where("judge_names is not null")
    return j.select("id", F.size(F.filter("judge_names", lambda x: F.length(x) > 3)).alias("judges"), L.bench_type(F.col("bench_size")).alias("by_size"), "bench_type")


_COLLAPSED = "trim(regexp_replace(replace(raw, chr(160), ' '), '\\s+', ' ', 'g'))"
_UNTITLED = f"regexp_replace(regexp_replace({_COLLAPSED}, '{L._AFTER}', ''), '{L._BEFORE}', '')".replace("hon'?ble", "hon''?ble")
_PLAIN = f"regexp_replace(regexp_replace(regexp_replace({_UNTITLED}, '[^A-Za-z0-9 .''-]', ' ', 'g'), '\\s+', ' ', 'g'), '^[ .-]+|[ .-]+$', '', 'g')"


@CORE.query(
    "judge_names",
    f"""WITH n AS (SELECT unnest(judge_names) AS raw FROM judgment), j AS (SELECT array_to_string(list_transform(string_split({_PLAIN}, ' '), lambda w: CASE WHEN w = upper(w) OR w = lower(w) THEN upper(w[1:1]) || lower(w[2:]) ELSE w END), ' ') AS judge FROM n WHERE raw IS NOT NULL)
    SELECT judge, count(*) AS n FROM j WHERE judge <> '' GROUP BY 1""",
)
def judge_names(spark, sf):
    """Judges without titles, by count. Column expressions alone; spellings are not linked here."""
    names = table(spark, sf, "judgment").select(F.explode("judge_names").alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    return names.select(L.judge_name(F.col("raw")).alias("judge"), "n").where("judge <> ''").groupBy("judge").agg(F.sum("n").alias("n"))


@CORE.query(
    "citation_edges",
    f"""WITH m AS (SELECT id, canonical_citation AS own, unnest(list_distinct(regexp_extract_all(full_text, '{L.CITATION_MENTION}', 1))) AS cited FROM judgment),
    h AS (SELECT canonical_citation AS cited, min(id) AS low, max(id) AS high FROM judgment GROUP BY 1)
    SELECT m.id, m.cited, CASE WHEN low = high THEN low END AS resolved_id, CASE WHEN low IS NULL THEN 'unresolved' WHEN low = high THEN 'linked' ELSE 'ambiguous' END AS resolution FROM m LEFT JOIN h USING (cited) WHERE m.cited <> m.own""",
)
def citation_edges(spark, sf):
    """Edges of the citation graph without self-links, each resolved to the one judgment it can mean."""
    j = table(spark, sf, "judgment")
    m = j.select("id", F.col("canonical_citation").alias("own"), F.explode(L.mentions(F.col("full_text"), L.CITATION_MENTION)).alias("cited")).where("cited <> own")
    return resolve_unique(m.select("id", "cited"), "cited", j.select(F.col("id").alias("jid"), "canonical_citation"), ["canonical_citation"], "jid")


@CORE.query(
    "citation_counts",
    f"""WITH m AS (SELECT DISTINCT id, canonical_citation AS own, unnest(list_distinct(regexp_extract_all(full_text, '{L.CITATION_MENTION}', 1))) AS cited FROM judgment)
    SELECT j.canonical_citation AS citation, count(DISTINCT m.id) AS cited_by FROM judgment j LEFT JOIN m ON m.cited = j.canonical_citation AND m.own <> m.cited GROUP BY 1""",
)
def citation_counts(spark, sf):
    """Distinct citing judgments of each judgment, zero included. Mentions are counted before they are joined."""
    j = table(spark, sf, "judgment")
    m = j.select("id", F.col("canonical_citation").alias("own"), F.explode(L.mentions(F.col("full_text"), L.CITATION_MENTION)).alias("citation")).where("citation <> own").groupBy("citation").agg(F.count_distinct("id").alias("n"))
    return j.select(F.col("canonical_citation").alias("citation")).join(m, "citation", "left").select("citation", F.coalesce("n", F.lit(0)).alias("cited_by"))


@CORE.query("instrument_kinds", "SELECT instrument_type, count(*) AS n, count(*) FILTER (WHERE regexp_matches(full_text, '(?i)amended by|amendment')) AS amending, count(*) FILTER (WHERE regexp_matches(full_text, '(?i)shall be (substituted|inserted|omitted)|repealed')) AS operative, count(affected_statute_id) AS linked FROM instrument GROUP BY 1")
def instrument_kinds(spark, sf):
    t = F.col("full_text")
    return table(spark, sf, "instrument").groupBy("instrument_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(t.rlike("(?i)amended by|amendment")).alias("amending"), F.count_if(t.rlike("(?i)shall be (substituted|inserted|omitted)|repealed")).alias("operative"), F.count("affected_statute_id").alias("linked")
    )


@CORE.query(
    "amendment_edges",
    "SELECT v.statute_id, i.id AS instrument_id, count(*) AS captures, min(v.effective_from) AS first_effect FROM statute_section_version v JOIN instrument i ON lower(trim(v.amending_instrument_id)) = i.id GROUP BY 1, 2",
)
def amendment_edges(spark, sf):
    """Edges of the amendment graph. Keys are counted before the join."""
    v = table(spark, sf, "statute_section_version").select("statute_id", F.lower(F.trim("amending_instrument_id")).alias("instrument_id"), "effective_from").where("instrument_id is not null")
    g = v.groupBy("statute_id", "instrument_id").agg(F.count(F.lit(1)).alias("captures"), F.min("effective_from").alias("first_effect"))
    return g.join(table(spark, sf, "instrument").select(F.col("id").alias("instrument_id")), "instrument_id", "left_semi")


_HEAD = "(?:Section )?([0-9]+[A-Z]?(?:-[A-Z])?)\\. "


@CORE.query(
    "document_sections",
    f"""WITH p AS (SELECT doc_id, unnest(list_filter(string_split(regexp_replace(text, '(?m)^({_HEAD})', chr(1) || '\\1', 'g'), chr(1)), lambda x: length(trim(x)) > 0)) AS part FROM documents WHERE length(trim(coalesce(text, ''))) > 0),
    s AS (SELECT doc_id, regexp_extract(part, '^{_HEAD}', 1) AS section_number, length(regexp_replace(regexp_replace(part, '^{_HEAD}', ''), '^\\s+|\\s+$', '', 'g')) AS chars FROM p)
    SELECT doc_id, section_number, max(chars) AS chars FROM s WHERE section_number <> '' GROUP BY 1, 2""".replace("\\\\", "\\"),
)
def document_sections(spark, sf):
    """Texts split at their numbered headings, the fuller text of each number."""
    s = split_sections(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    return fuller_text_wins(s, "doc_id", "section_number", "section_text", "ordinal").select("doc_id", "section_number", F.length("section_text").alias("chars"))


@CORE.query(
    "section_counts",
    "SELECT doc_id, len(regexp_extract_all(chr(10) || text, '\\n(?:Section )?[0-9]+[A-Z]?(?:-[A-Z])?\\. ')) AS headings FROM documents WHERE regexp_matches(chr(10) || text, '\\n(?:Section )?[0-9]+[A-Z]?(?:-[A-Z])?\\. ')",
)
def section_counts(spark, sf):
    """Numbered headings per text, counted from the split sections."""
    s = split_sections(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text").where("section_number is not null")
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("headings"))


_NUMBERED = """WITH x AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), y AS (SELECT doc_id, unnest(l) AS t, generate_subscripts(l, 1) - 1 AS line FROM x),
    n AS (SELECT doc_id, line, t, TRY_CAST(nullif(regexp_extract(t, '^([0-9]{1,4})(?:[.)]| )', 1), '') AS INTEGER) AS number FROM y)"""


def _numbered_lines(spark, sf):
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return d.withColumn("number", F.nullif(F.regexp_extract("t", "^([0-9]{1,4})(?:[.)]| )", 1), F.lit("")).cast("int")).where("number is not null")


@CORE.query(
    "carry_forward_merge",
    _NUMBERED + """, b AS (SELECT *, number BETWEEN 1800 AND 2100 AS bogus FROM n WHERE number IS NOT NULL), l AS (SELECT *, max(CASE WHEN NOT bogus THEN line END) OVER (PARTITION BY doc_id ORDER BY line) AS into_line FROM b)
    SELECT doc_id, into_line AS line, string_agg(t, chr(10) ORDER BY line) AS t, count(*) - 1 AS merged FROM l WHERE into_line IS NOT NULL GROUP BY 1, 2""",
)
def carry_forward(spark, sf):
    """Numbered lines of documents, those numbered by a year appended to the last line of a real number before them."""
    return carry_forward_merge(_numbered_lines(spark, sf), "doc_id", "line", F.col("number").between(1800, 2100), "t")


_SOUND = "list_sort(list_distinct(list_filter(nums, lambda n: n NOT BETWEEN 1800 AND 2100 AND n <= 5000)))"


@CORE.query(
    "fake_heading_numbers",
    _NUMBERED + f""", g AS (SELECT doc_id, list(number) AS nums FROM n WHERE number IS NOT NULL GROUP BY 1), r AS (SELECT doc_id, {_SOUND} AS present FROM g),
    o AS (SELECT DISTINCT n.doc_id, n.number, list_filter(present, lambda x: x <> n.number) AS others FROM n JOIN r USING (doc_id) WHERE n.number IS NOT NULL)
    SELECT doc_id, number FROM o WHERE number BETWEEN 1800 AND 2100 OR number > 5000 OR (number >= 100 AND number > 5 + CASE WHEN len(others) = 0 THEN 0 WHEN len(others) = 1 THEN others[1] ELSE greatest(others[len(others) // 2 + 1], others[len(others) - 1]) END)""",
)
def fake_heading_numbers(spark, sf):
    """Numbers of lines that are years, or far off the other numbers of their document."""
    n = _numbered_lines(spark, sf).select("doc_id", "number").distinct()
    g = n.groupBy("doc_id").agg(F.collect_list("number").alias("nums"))
    return n.join(g, "doc_id").where(is_fake_number(F.col("number"), F.col("nums"))).select("doc_id", "number")


@CORE.query(
    "reextract_gate",
    """WITH b AS (SELECT DISTINCT statute_id AS doc, section_number AS number FROM statute_section_version WHERE effective_from IS NULL OR version_no = 1),
    a AS (SELECT statute_id AS doc, section_number AS number, max(length(section_text)) AS chars FROM statute_section_version WHERE version_no > 1 GROUP BY 1, 2),
    j AS (SELECT coalesce(b.doc, a.doc) AS doc, coalesce(b.number, a.number) AS number, b.doc IS NOT NULL AS hb, a.doc IS NOT NULL AS ha, chars FROM b FULL OUTER JOIN a ON a.doc = b.doc AND a.number = b.number),
    g AS (SELECT doc, count(*) FILTER (WHERE hb) AS had, count(*) FILTER (WHERE hb AND ha) AS kept, count(*) FILTER (WHERE hb AND NOT ha) AS lost, count(*) FILTER (WHERE number = '1' AND hb AND NOT ha) AS lost_first, coalesce(max(chars), 0) AS longest FROM j GROUP BY 1)
    SELECT doc, kept, lost, CASE WHEN had = 0 THEN 'pass' WHEN kept * 2 < had AND lost > 2 THEN 'lost_half' WHEN lost_first > 0 THEN 'lost_first' WHEN longest > 20000 THEN 'mega_section' ELSE 'pass' END AS verdict FROM g""",
)
def reextract(spark, sf):
    v = table(spark, sf, "statute_section_version")
    return reextract_gate(v.where("effective_from is null or version_no = 1"), v.where("version_no > 1"), "statute_id", "section_number", "section_text")


@CORE.query("thin_records", "SELECT access_method, count(*) AS n, count(*) FILTER (WHERE length(trim(coalesce(full_text, ''))) < 200) AS thin FROM judgment GROUP BY 1")
def thin_records(spark, sf):
    return table(spark, sf, "judgment").groupBy("access_method").agg(F.count(F.lit(1)).alias("n"), F.count_if(T.text_is_thin(F.col("full_text"))).alias("thin"))
