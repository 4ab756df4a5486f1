"""Records of judgments and their children: lookups, guards, readings reconciled, exports, accounting of what is held."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from docketry.functions import dates as D
from docketry.functions import guards as G
from docketry.functions import legal as L
from docketry.functions import statutes as S
from docketry.functions import urls as U
from docketry.functions.text import collapse, collapse_letter_spaced, summary
from docketry.functions.lines import similarity
from docketry.functions.volumes import CAPTION_END, JUNK, best_body, caption, case_head, clean_text, contents_entries, split_volumes
from docketry.operators.skew import skew_join
from docketry.operators.visibility import page, servable
from docketry.plans.registry import CORE, quoted
from docketry.session import ensure_checkpoint_dir
from docketry.sources.sinks import mirror, write_once
from docketry.sources.tables import table

_COLL = "trim(regexp_replace(replace({0}, chr(160), ' '), '\\s+', ' ', 'g'))"
_SERVABLE = "NOT EXISTS (SELECT 1 FROM deleted_record d WHERE d.table_name = 'judgment' AND d.record_id = j.id)"


def _deleted(spark, sf):
    return table(spark, sf, "deleted_record").where("table_name = 'judgment'")


@CORE.query(
    "get_judgment",
    f"""WITH w AS (SELECT id, canonical_citation, case_title FROM judgment j WHERE {_SERVABLE} ORDER BY canonical_citation LIMIT 3)
    SELECT w.id, w.case_title, list_sort(list(CASE WHEN e.citation = w.canonical_citation THEN 0 ELSE 1 END || ' ' || e.citation) FILTER (WHERE e.case_id IS NOT NULL)) AS citations FROM w LEFT JOIN enumerated_case e ON e.citation = w.canonical_citation OR list_contains(e.parallel_citations, w.canonical_citation) GROUP BY 1, 2""",
)
def get_judgment(spark, sf):
    """Judgments by citation with the listed citations that belong to them, the primary one first. Both kinds of match are equi-joins."""
    w = page(servable(table(spark, sf, "judgment"), "id", _deleted(spark, sf), "record_id").select("id", "canonical_citation", "case_title"), ["canonical_citation"], 3)
    e = table(spark, sf, "enumerated_case").select("case_id", "citation", F.explode(F.array_distinct(F.concat(F.array("citation"), F.coalesce("parallel_citations", F.array().cast("array<string>"))))).alias("canonical_citation"))
    e = e.join(F.broadcast(w.select("canonical_citation")), "canonical_citation", "left_semi")
    child = F.when(F.col("case_id").isNotNull(), F.concat(F.when(F.col("citation") == F.col("canonical_citation"), "0 ").otherwise("1 "), "citation"))
    return w.join(e, "canonical_citation", "left").groupBy("id", "case_title").agg(F.array_sort(F.collect_list(child)).alias("c")).select("id", "case_title", F.when(F.size("c") > 0, F.col("c")).alias("citations"))


@CORE.query("get_citations", "SELECT e.case_id, e.citation, j.id AS judgment_id, j.case_title FROM enumerated_case e JOIN judgment j ON j.canonical_citation = e.citation WHERE e.case_id <= 500 ORDER BY e.case_id LIMIT 100")
def get_citations(spark, sf):
    """A page of listed citations with the judgment that each belongs to."""
    e = table(spark, sf, "enumerated_case").where("case_id <= 500").select("case_id", "citation")
    j = table(spark, sf, "judgment").select(F.col("canonical_citation").alias("citation"), F.col("id").alias("judgment_id"), "case_title")
    return page(e.join(j, "citation"), ["case_id"], 100).select("case_id", "citation", "judgment_id", "case_title")


@CORE.query(
    "filtered_judgments",
    """SELECT id, canonical_citation FROM judgment j WHERE (contains(lower(canonical_citation), 'scmr') OR contains(lower(case_title), 'state') OR contains(lower(court_name), 'shariat')) AND contains(full_text, 'section 1') AND EXISTS (SELECT 1 FROM case_metadata m WHERE m.judgment_id = j.id AND m.headnotes IS NOT NULL) AND length(trim(coalesce(full_text, ''))) > 0""",
)
def filtered_judgments(spark, sf):
    """The optional filters of a listing: words over three columns, a section, the existence of headnotes, a body."""
    has = lambda c, w: F.contains(F.lower(c), F.lit(w))
    j = table(spark, sf, "judgment").where((has("canonical_citation", "scmr") | has("case_title", "state") | has("court_name", "shariat")) & F.contains("full_text", F.lit("section 1")) & (F.length(F.trim("full_text")) > 0))
    noted = table(spark, sf, "case_metadata").where("headnotes is not null").select(F.col("judgment_id").alias("id")).distinct()
    return j.join(noted, "id", "left_semi").select("id", "canonical_citation")


@CORE.query(
    "export_statutes",
    """WITH c AS (SELECT statute_id, section_number, max_by(id, (coalesce(effective_from, DATE '0001-01-01'), created_at, id)) AS id FROM statute_section_version GROUP BY 1, 2)
    SELECT s.name, c.section_number, v.effective_from, length(v.section_text) AS chars FROM c JOIN statute_section_version v ON v.id = c.id JOIN statute s ON s.id = c.statute_id""",
)
def export_statutes(spark, sf):
    """Every section with its statute and its current version, which is an aggregate of (date, capture, id)."""
    v = table(spark, sf, "statute_section_version")
    best = F.max(F.struct(F.coalesce("effective_from", F.lit("0001-01-01").cast("date")).alias("d"), "created_at", "id", "effective_from", F.length("section_text").alias("chars")))
    c = v.groupBy("statute_id", "section_number").agg(best.alias("b"))
    return c.join(table(spark, sf, "statute").select(F.col("id").alias("statute_id"), "name"), "statute_id").select("name", "section_number", F.col("b.effective_from").alias("effective_from"), F.col("b.chars").alias("chars"))


@CORE.query("section_records", "SELECT v.id, '1' AS schema_version, s.name AS statute, v.section_number AS number, v.section_text AS text FROM statute_section_version v JOIN statute s ON s.id = v.statute_id WHERE v.section_text IS NOT NULL AND v.section_number IS NOT NULL")
def section_records(spark, sf):
    """Versioned JSON records of sections, written and read back."""
    s = table(spark, sf, "statute").select(F.col("id").alias("statute_id"), "name")
    v = table(spark, sf, "statute_section_version").where("section_text is not null and section_number is not null").join(s, "statute_id")
    r = v.select("id", F.to_json(F.struct(F.lit(1).alias("schema_version"), "id", F.col("name").alias("statute"), F.col("section_number").alias("number"), F.col("section_text").alias("text"))).alias("record"))
    return r.select("id", *[F.get_json_object("record", f"$.{n}").alias(n) for n in ("schema_version", "statute", "number", "text")])


@CORE.query("mirror_versions", "SELECT id, 'statutes/' || statute_id || '/' || section_number || '/' || id AS key FROM statute_section_version v WHERE NOT EXISTS (SELECT 1 FROM judgment_upload_work w WHERE lower(trim(w.judgment_id)) = v.id) AND section_text <> ''")
def mirror_versions(spark, sf):
    """Versions whose key is not among what has been written."""
    done = table(spark, sf, "judgment_upload_work").select(F.lower(F.trim("judgment_id")).alias("id")).where("id is not null").distinct()
    return table(spark, sf, "statute_section_version").where("section_text <> ''").join(done, "id", "left_anti").select("id", F.concat_ws("/", F.lit("statutes"), "statute_id", "section_number", "id").alias("key"))


@CORE.query("mirror_instruments", "SELECT id, 'instruments/' || instrument_type || '/' || coalesce(CAST(year(instrument_date) AS VARCHAR), 'undated') || '/' || id AS key FROM instrument i WHERE NOT EXISTS (SELECT 1 FROM statute_section_version v WHERE lower(trim(v.amending_instrument_id)) = i.id)")
def mirror_instruments(spark, sf):
    """Instruments that no version refers to, with the key they are stored under."""
    used = table(spark, sf, "statute_section_version").select(F.lower(F.trim("amending_instrument_id")).alias("id")).where("id is not null").distinct()
    return table(spark, sf, "instrument").join(used, "id", "left_anti").select("id", F.concat_ws("/", F.lit("instruments"), "instrument_type", F.coalesce(F.year("instrument_date").cast("string"), F.lit("undated")), "id").alias("key"))


@CORE.query(
    "staging_identity",
    f"SELECT id, lower(coalesce(affected_statute_id, '')) || '|' || coalesce(nullif({_COLL.format('instrument_number')}, ''), nullif({_COLL.format('title')}, ''), '') AS identity FROM instrument",
)
def staging_identity(spark, sf):
    """One file may hold several acts: a record is known by its file and the number of its act, else its title."""
    return table(spark, sf, "instrument").select("id", F.concat_ws("|", F.lower(F.coalesce("affected_statute_id", F.lit(""))), F.coalesce(F.nullif(collapse(F.col("instrument_number")), F.lit("")), F.nullif(collapse(F.col("title")), F.lit("")), F.lit(""))).alias("identity"))


_STRUCT = f"coalesce(regexp_matches(t, {quoted(G.STRUCTURE)}), false)"
_TIGHT = "length(regexp_replace(t, '\\s+', '', 'g'))"
_SHARE = f"(CASE WHEN {_TIGHT} > 0 THEN ({_TIGHT} - length(regexp_replace(regexp_replace(t, {quoted(G.CHROME)}, ' ', 'g'), '\\s+', '', 'g'))) / {_TIGHT} ELSE 1 END)"
_SAID = f"regexp_matches(t, {quoted(G.CHROME)})"
_TAIL = r"regexp_extract(t, '(?is)^.*\n[^\n]*(?:dates?\s*(?:\(\s*s\s*\))?\s+of\s+[hb]earing|date\s+of\s+institution)\s*:[^\n]*\n(.*)$', 1)"
_HEADONLY = f"(regexp_matches(t, {quoted(G.HEARING)}) AND length(array_to_string(list_transform(list_filter(string_split({_TAIL}, chr(10)), lambda x: trim(x) <> '' AND NOT regexp_matches(x, {quoted(G.COUNSEL)})), lambda x: trim(x)), '')) < 300)"
_DOMINATES = f"({_SAID} AND ({_TIGHT} < 400 OR {_SHARE} >= 0.25 OR (NOT {_STRUCT} AND {_TIGHT} < 1200)))"


@CORE.query(
    "judgment_guards",
    f"""WITH j AS (SELECT id, judge_names, coalesce(full_text, '') AS t FROM judgment)
    SELECT id, list_filter([CASE WHEN trim(t) = '' THEN 'empty' END, CASE WHEN {_DOMINATES} THEN 'chrome' END, CASE WHEN {_HEADONLY} THEN 'headnotes' END, CASE WHEN trim(t) <> '' AND NOT {_STRUCT} THEN 'no_structure' END, CASE WHEN {_TIGHT} BETWEEN 1 AND 399 THEN 'thin' END], lambda x: x IS NOT NULL) AS faults,
      coalesce(len(judge_names), 0) > 0 AND length(t) >= 5000 AND NOT {_HEADONLY} AS full_ready FROM j""",
)
def judgment_guards(spark, sf):
    """What keeps a text from being a whole judgment, and whether it is one in full."""
    t = F.col("full_text")
    return table(spark, sf, "judgment").select("id", G.guard_flags(t).alias("faults"), G.is_full_ready(t, F.col("judge_names")).alias("full_ready"))


@CORE.query(
    "page_guards",
    f"""WITH p AS (SELECT page_id, html, trim(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', ' ', 'g'), '<[^>]*>', chr(10), 'g')) || CASE WHEN page_id % 7 = 0 THEN ' Update subscriber. Obtaining  subscription' ELSE '' END AS t FROM page_result),
    q AS (SELECT *, coalesce(regexp_matches(html, {quoted(G.PASSWORD_FIELD)}), false) AS f FROM p)
    SELECT page_id, ({_SAID} OR f) AND ({_TIGHT} < 400 OR ({_SAID} AND {_SHARE} >= 0.25) OR (NOT {_STRUCT} AND (f OR {_TIGHT} < 1200))) AS dominated, round({_SHARE}, 6) AS share FROM q""",
)
def page_guards(spark, sf):
    """Pages, every seventh given phrases of a subscription, that are about subscriptions and logins."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>", " "), "<[^>]*>", "\n")
    t = F.concat(F.trim(bare), F.when(F.col("page_id") % 7 == 0, " Update subscriber. Obtaining  subscription").otherwise(""))
    return table(spark, sf, "page_result").select("page_id", G.chrome_dominates(t, F.col("html")).alias("dominated"), F.round(G.chrome_share(t), 6).alias("share"))


@CORE.query(
    "viewer_lines",
    rf"""WITH t AS (SELECT id, string_split('×' || chr(10) || 'Case Description' || chr(10) || chr(10) || 'Citation Name: ' || canonical_citation || chr(10) || coalesce(full_text, ''), chr(10)) AS l FROM judgment),
    k AS (SELECT *, array_to_string(list_transform(l, lambda x: CASE WHEN trim(x) = '' OR regexp_matches(x, {quoted(G.VIEWER_LINE)}) THEN 'v' ELSE 't' END), '') AS k FROM t)
    SELECT id, CASE WHEN contains(k, 't') THEN md5(trim(array_to_string(l[strpos(k, 't'):], chr(10)))) ELSE md5('') END AS body FROM k""",
)
def viewer_lines(spark, sf):
    """Judgments behind the lines of a viewer, with those lines taken off."""
    t = F.concat(F.lit("×\nCase Description\n\nCitation Name: "), "canonical_citation", F.lit("\n"), F.coalesce("full_text", F.lit("")))
    return table(spark, sf, "judgment").select("id", F.md5(G.strip_viewer_lines(t)).alias("body"))


@CORE.query(
    "header_courts",
    rf"""WITH h AS (SELECT id, court_name, regexp_replace(trim(regexp_extract(full_text, {quoted(G.COURT_LINE)}, 1)), '(?i)^(in )?the ', '') AS c FROM judgment WHERE full_text IS NOT NULL), n AS (SELECT id, court_name, lower(regexp_replace(c, '\s+', ' ', 'g')) AS c FROM h WHERE c <> '')
    SELECT id, c AS court, c = lower(court_name) AS agrees FROM n""",
)
def header_courts(spark, sf):
    """The court that the head of a text names, in lower case, and whether it is the one on record."""
    j = table(spark, sf, "judgment").where("full_text is not null").select("id", "court_name", F.lower(G.header_court(F.col("full_text"))).alias("court")).where("court is not null")
    return j.select("id", "court", (F.col("court") == F.lower("court_name")).alias("agrees"))


@CORE.query(
    "court_directory",
    r"""WITH c AS (SELECT court_id, court_name, count(*) AS n FROM judgment WHERE court_id IS NOT NULL GROUP BY 1, 2), d AS (SELECT court_id, max_by(court_name, (n, court_name)) AS name FROM c GROUP BY 1),
    a AS (SELECT lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) AS k, min(name) AS name FROM d GROUP BY 1), e AS (SELECT case_id, court, lower(regexp_replace(court, '[^A-Za-z0-9]', '', 'g')) AS k FROM enumerated_case WHERE court IS NOT NULL)
    SELECT case_id, court, a.name AS known FROM e LEFT JOIN a USING (k)""",
)
def court_directory(spark, sf):
    """Courts of listed cases by their name in the directory that the judgments make: names compare without punctuation, case and blanks."""
    fold = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    c = table(spark, sf, "judgment").where("court_id is not null").groupBy("court_id", "court_name").agg(F.count(F.lit(1)).alias("n"))
    d = c.groupBy("court_id").agg(F.max_by("court_name", F.struct("n", "court_name")).alias("name")).groupBy(fold("name").alias("k")).agg(F.min("name").alias("known"))
    e = table(spark, sf, "enumerated_case").where("court is not null").select("case_id", "court", fold("court").alias("k"))
    return e.join(d, "k", "left").select("case_id", "court", "known")


@CORE.query(
    "case_numbers",
    rf"""WITH n AS (SELECT id, court_name, decision_date, full_text_hash, nullif({_COLL.format(f'regexp_extract(full_text, {quoted(S.CASE_NUMBER)}, 1)')}, '') AS number FROM judgment)
    SELECT id, number, coalesce('UNREPORTED ' || left(court_name, 20) || ' ' || left(number, 140) || coalesce(' (' || strftime(decision_date, '%Y-%m-%d') || ')', ''), 'UNREPORTED ' || left(court_name, 20) || ' ' || coalesce(strftime(decision_date, '%Y-%m-%d'), 'undated') || ' #' || left(coalesce(full_text_hash, ''), 12)) AS identity FROM n""",
)
def case_numbers(spark, sf):
    """The case number that a text gives, and the identity of the judgment if it is unreported."""
    j = table(spark, sf, "judgment").select("id", "court_name", "decision_date", "full_text_hash", S.case_number(F.col("full_text"), F.lit(None).cast("string")).alias("number"))
    return j.select("id", "number", S.unreported_identity(F.col("court_name"), F.col("number"), F.col("decision_date"), F.col("full_text_hash")).alias("identity"))


@CORE.query("identity_tuples", "SELECT id, CASE WHEN court_id IS NOT NULL AND docket_key IS NOT NULL AND decision_date IS NOT NULL THEN court_id || '|' || docket_key || '|' || CAST(decision_date AS VARCHAR) END AS identity, count(*) OVER (PARTITION BY court_id, docket_key, decision_date) AS holders FROM judgment WHERE court_id IS NOT NULL AND docket_key IS NOT NULL AND decision_date IS NOT NULL")
def identity_tuples(spark, sf):
    """The identity of each judgment, of which no part may be null, and how many have it; counted before it is joined back."""
    key = ["court_id", "docket_key", "decision_date"]
    j = table(spark, sf, "judgment").select("id", *key).dropna(subset=key)
    n = j.groupBy(*key).agg(F.count(F.lit(1)).alias("holders"))
    return j.join(n, key).select("id", F.concat_ws("|", "court_id", "docket_key", F.col("decision_date").cast("string")).alias("identity"), "holders")


@CORE.query(
    "alias_suspicions",
    f"""WITH e AS (SELECT citation, unnest(parallel_citations) AS alias FROM enumerated_case), a AS (SELECT DISTINCT j.id, e.alias, j.full_text FROM e JOIN judgment j ON j.canonical_citation = e.citation WHERE e.alias IS NOT NULL AND e.alias <> e.citation)
    SELECT id, alias, CASE WHEN full_text IS NULL OR NOT contains(lower({_COLL.format("coalesce(full_text, '')")}), lower({_COLL.format('alias')})) THEN 'not_in_text' WHEN regexp_matches(full_text, '(?i)(see|cited in|relied on) ') THEN 'cited' ELSE 'ok' END AS reason FROM a""",
)
def alias_suspicions(spark, sf):
    """Citations that are listed beside a judgment's own, and whether its text bears them out."""
    e = table(spark, sf, "enumerated_case").select(F.col("citation").alias("canonical_citation"), F.explode("parallel_citations").alias("alias")).where("alias is not null and alias <> canonical_citation").distinct()
    j = table(spark, sf, "judgment").select("id", "canonical_citation", "full_text")
    t = F.coalesce("full_text", F.lit(""))
    inside = F.contains(F.lower(collapse(t)), F.lower(collapse(F.col("alias"))))
    reason = F.when(F.col("full_text").isNull() | ~inside, "not_in_text").when(t.rlike("(?i)(see|cited in|relied on) "), "cited").otherwise("ok")
    return e.join(j, "canonical_citation").select("id", "alias", reason.alias("reason")).distinct()


@CORE.query("referred_citations", f"SELECT id, list_sort(list_distinct(regexp_extract_all(full_text || ' It cites ' || canonical_citation || ' ref.', {quoted(L.CITATION_MENTION + G.REFERRED)}, 1))) AS referred FROM judgment WHERE full_text IS NOT NULL")
def referred_citations(spark, sf):
    """Citations that are followed by a mark of reference; each text is given one of its own."""
    t = F.concat("full_text", F.lit(" It cites "), "canonical_citation", F.lit(" ref."))
    return table(spark, sf, "judgment").where("full_text is not null").select("id", F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(L.CITATION_MENTION + G.REFERRED), F.lit(1)))).alias("referred"))


@CORE.query("also_reported", f"SELECT case_id, list_sort(list_distinct(regexp_extract_all(title || ' (also reported as ' || coalesce(array_to_string(parallel_citations, ' = '), '') || ')', {quoted(G.ALSO_REPORTED + L.CITATION_MENTION)}, 1))) AS also FROM enumerated_case WHERE title IS NOT NULL")
def also_reported(spark, sf):
    """Parallel citations read back from a caption that names them."""
    t = F.concat("title", F.lit(" (also reported as "), F.coalesce(F.array_join("parallel_citations", " = "), F.lit("")), F.lit(")"))
    return table(spark, sf, "enumerated_case").where("title is not null").select("case_id", F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(G.ALSO_REPORTED + L.CITATION_MENTION), F.lit(1)))).alias("also"))


_YEAR_FIRST = r"(?:18|19|20)[0-9]{2} [A-Z][A-Za-z]{2,5} [0-9]+"


@CORE.query(
    "bracket_courts",
    rf"""WITH t AS (SELECT case_id, citation || CASE case_id % 4 WHEN 0 THEN ' [Karachi]' WHEN 1 THEN ' (2) [Banking Court, Multan]' WHEN 2 THEN ' [sic]' ELSE ' relied on [Lahore]' END AS t FROM enumerated_case), n AS (SELECT case_id, trim(regexp_extract(t, '{_YEAR_FIRST}[\s().,;:0-9-]*\[\s*([A-Za-z][A-Za-z\s.&,()-]{{1,78}}?)\s*\]', 1)) AS name FROM t)
    SELECT case_id, name AS court FROM n WHERE regexp_matches(name, '(?i)\b(court|tribunal|bench|commission|board)\b|^(lahore|karachi|peshawar|quetta|islamabad|supreme court|sc)$')""",
)
def bracket_courts(spark, sf):
    """Courts in brackets directly behind a citation; editors' brackets and those after words are none."""
    tails = F.when(F.col("case_id") % 4 == 0, " [Karachi]").when(F.col("case_id") % 4 == 1, " (2) [Banking Court, Multan]").when(F.col("case_id") % 4 == 2, " [sic]").otherwise(" relied on [Lahore]")
    return table(spark, sf, "enumerated_case").select("case_id", G.bracket_court(F.concat("citation", tails), _YEAR_FIRST).alias("court")).where("court is not null")


@CORE.query("order_sheet_titles", "SELECT case_id, petitioner || ' v. ' || respondent AS title FROM (SELECT case_id, trim(petitioner) AS petitioner, trim(respondent) AS respondent FROM case_metadata) WHERE petitioner <> '' AND respondent <> '' AND NOT regexp_matches(petitioner || '|' || respondent, '\\n') AND regexp_matches(petitioner, '[a-z]{3}') AND regexp_matches(respondent, '[a-z]{3}')")
def order_sheet_titles(spark, sf):
    """Titles read from the lines of an order sheet that gives names and roles one below the other."""
    m = table(spark, sf, "case_metadata").select("case_id", F.trim("petitioner").alias("p"), F.trim("respondent").alias("r")).where("p <> '' and r <> ''").where(F.col("p").rlike("[a-z]{3}") & F.col("r").rlike("[a-z]{3}"))
    sheet = F.concat(F.lit("ORDER SHEET\n"), "p", F.lit("\n... Petitioner\nVERSUS\n"), "r", F.lit("\n…Respondents\n"))
    return m.select("case_id", G.order_sheet_title(sheet).alias("title")).where("title is not null")


@CORE.query(
    "judgment_records",
    rf"""WITH t AS (SELECT id, full_text AS t FROM judgment WHERE full_text IS NOT NULL)
    SELECT id, nullif(regexp_extract(t, '(?m)^([^\n]{{3,90}}? (?:v\.|vs\.|versus|VERSUS|Vs\.) [^\n]{{2,90}}?)\s*$', 1), '') AS title, nullif(regexp_extract(t, '(?m)^\s*([A-Z][A-Za-z. ]{{0,12}}No\. ?[0-9]+\S* of [0-9]{{4}})\s*$', 1), '') AS docket,
      nullif(regexp_extract(t, 'Date of hearing: ([0-9]{{1,2}} [A-Z][a-z]+ [0-9]{{4}})', 1), '') AS hearing, len(list_distinct(regexp_extract_all(t, '{L.CITATION_MENTION}', 1))) AS citations, len(list_distinct(regexp_extract_all(t, '{L.ACT_MENTION}', 1))) AS statutes, length(t) AS chars FROM t""",
)
def judgment_records(spark, sf):
    """One record per text: title, docket, hearing, and how many citations and statutes it names."""
    t = F.col("full_text")
    first = lambda p: F.nullif(F.regexp_extract(t, p, 1), F.lit(""))
    return table(spark, sf, "judgment").where(t.isNotNull()).select(
        "id", first(r"(?m)^([^\n]{3,90}? (?:v\.|vs\.|versus|VERSUS|Vs\.) [^\n]{2,90}?)\s*$").alias("title"), first(r"(?m)^\s*([A-Z][A-Za-z. ]{0,12}No\. ?[0-9]+\S* of [0-9]{4})\s*$").alias("docket"), first("Date of hearing: ([0-9]{1,2} [A-Z][a-z]+ [0-9]{4})").alias("hearing"),
        F.size(L.mentions(t, L.CITATION_MENTION)).alias("citations"), F.size(L.mentions(t, L.ACT_MENTION)).alias("statutes"), F.length(t).alias("chars"),
    )


@CORE.query(
    "instrument_records",
    rf"""SELECT id, nullif(trim(regexp_extract(full_text, '(?m)^GOVERNMENT OF ([A-Z ]+)$', 1)), '') AS government, nullif(regexp_extract(full_text, {quoted(S.MENTIONS['SRO'][0])}, 2), '') AS year, len(list_distinct(regexp_extract_all(full_text, '{L.ACT_MENTION}', 1))) AS statutes, len(regexp_extract_all(full_text, {quoted(L.SECTION_MENTION)}, 1)) AS sections FROM instrument WHERE full_text IS NOT NULL""",
)
def instrument_records(spark, sf):
    """One record per instrument: government, year of its number, statutes and sections that it names."""
    t = F.col("full_text")
    return table(spark, sf, "instrument").where(t.isNotNull()).select(
        "id", F.nullif(F.trim(F.regexp_extract(t, "(?m)^GOVERNMENT OF ([A-Z ]+)$", 1)), F.lit("")).alias("government"), F.nullif(F.regexp_extract(t, S.MENTIONS["SRO"][0], 2), F.lit("")).alias("year"),
        F.size(L.mentions(t, L.ACT_MENTION)).alias("statutes"), F.size(F.regexp_extract_all(t, F.lit(L.SECTION_MENTION), F.lit(1))).alias("sections"),
    )


@CORE.query(
    "statute_records",
    """SELECT s.id, s.name, lower(regexp_extract(s.name, '(Act|Ordinance|Order|Rules|Regulations|Code)', 1)) AS kind, TRY_CAST(regexp_extract(s.name, '((?:18|19|20)[0-9]{2})[^0-9]*$', 1) AS INTEGER) AS year, count(DISTINCT v.section_number) AS sections, coalesce(sum(length(v.section_text)), 0)::BIGINT AS chars FROM statute s LEFT JOIN statute_section_version v ON v.statute_id = s.id GROUP BY 1, 2""",
)
def statute_records(spark, sf):
    """One record per statute: kind and year from its name, sections and characters; aggregated before the join."""
    v = table(spark, sf, "statute_section_version").groupBy("statute_id").agg(F.count_distinct("section_number").alias("sections"), F.sum(F.length("section_text")).alias("chars"))
    s = table(spark, sf, "statute").join(v, F.col("id") == F.col("statute_id"), "left")
    year = F.nullif(F.regexp_extract("name", "((?:18|19|20)[0-9]{2})[^0-9]*$", 1), F.lit("")).cast("int")
    return s.select("id", "name", F.lower(F.regexp_extract("name", "(Act|Ordinance|Order|Rules|Regulations|Code)", 1)).alias("kind"), year.alias("year"), F.coalesce("sections", F.lit(0)).alias("sections"), F.coalesce("chars", F.lit(0)).alias("chars"))


@CORE.query(
    "reconciled_statutes",
    """WITH r AS (SELECT s.id, s.year_enacted AS y1, TRY_CAST(regexp_extract(s.name, '((?:18|19|20)[0-9]{2})[^0-9]*$', 1) AS INTEGER) AS y2, s.statute_type AS t1, lower(regexp_extract(s.name, '(Act|Ordinance|Order|Rules|Regulations|Code)', 1)) AS t2 FROM statute s)
    SELECT id, coalesce(y1, y2) AS year, coalesce(t1, t2) AS kind, coalesce(y1 <> y2, false)::INTEGER + coalesce(t1 <> t2, false)::INTEGER AS conflicts FROM r""",
)
def reconciled_statutes(spark, sf):
    """Year and kind of each statute from the record and from its name; the record wins, a difference is a conflict."""
    r = statute_records(spark, sf).select("id", F.col("year").alias("y2"), F.col("kind").alias("t2")).join(table(spark, sf, "statute").select("id", F.col("year_enacted").alias("y1"), F.col("statute_type").alias("t1")), "id")
    differ = lambda a, b: F.coalesce(F.col(a) != F.col(b), F.lit(False)).cast("int")
    return r.select("id", F.coalesce("y1", "y2").alias("year"), F.coalesce("t1", "t2").alias("kind"), (differ("y1", "y2") + differ("t1", "t2")).alias("conflicts"))


@CORE.query(
    "reconciled_instruments",
    rf"""WITH r AS (SELECT id, year(instrument_date) AS y1, TRY_CAST(nullif(regexp_extract(full_text, {quoted(S.MENTIONS['SRO'][0])}, 2), '') AS INTEGER) AS y2, {_COLL.format("coalesce(instrument_number, '')")} AS n, {_COLL.format("coalesce(full_text, '')")} AS t FROM instrument)
    SELECT id, coalesce(y1, y2) AS year, coalesce(y1 <> y2, false) AS conflict, n <> '' AND contains(t, n) AS evidenced FROM r""",
)
def reconciled_instruments(spark, sf):
    """Year of each instrument from its date and its text, and whether its number stands in the text."""
    y1, y2 = F.year("instrument_date"), F.nullif(F.regexp_extract("full_text", S.MENTIONS["SRO"][0], 2), F.lit("")).cast("int")
    n, t = collapse(F.coalesce("instrument_number", F.lit(""))), collapse(F.coalesce("full_text", F.lit("")))
    return table(spark, sf, "instrument").select("id", F.coalesce(y1, y2).alias("year"), F.coalesce(y1 != y2, F.lit(False)).alias("conflict"), ((n != "") & F.contains(t, n)).alias("evidenced"))


@CORE.query("citations_in_texts", f"SELECT id, contains(lower({_COLL.format('full_text')}), lower({_COLL.format('canonical_citation')})) OR list_contains(regexp_extract_all(full_text, '{L.CITATION_MENTION}', 1), canonical_citation) AS evidenced FROM judgment WHERE full_text IS NOT NULL")
def citations_in_texts(spark, sf):
    """Whether a judgment's citation stands in its own text, as it is or as a mention."""
    t = F.col("full_text")
    inside = F.contains(F.lower(collapse(t)), F.lower(collapse(F.col("canonical_citation"))))
    return table(spark, sf, "judgment").where(t.isNotNull()).select("id", (inside | F.array_contains(F.regexp_extract_all(t, F.lit(L.CITATION_MENTION), F.lit(1)), F.col("canonical_citation"))).alias("evidenced"))


@CORE.query(
    "query_forms",
    r"""WITH q AS (SELECT case_id, nullif(trim(reporter), '') AS reporter, nullif(trim(citation), '') AS citation, CASE WHEN case_id % 3 = 0 THEN nullif(trim(court), '') END AS court, upper(regexp_replace(coalesce(reporter, ''), '[\s.]', '', 'g')) AS code FROM enumerated_case)
    SELECT case_id, code, CAST(len(list_filter([reporter, citation, court], lambda x: x IS NOT NULL)) AS INTEGER) AS fields, (reporter IS NOT NULL OR citation IS NOT NULL) AND court IS NULL AS citation_only FROM q""",
)
def query_forms(spark, sf):
    """Queries with the fields that are set, and those that ask for a citation alone."""
    e = table(spark, sf, "enumerated_case")
    fields = F.create_map(F.lit("reporter"), "reporter", F.lit("citation"), "citation", F.lit("court"), F.when(F.col("case_id") % 3 == 0, F.col("court")))
    return e.select("case_id", S.reporter_code(F.col("reporter")).alias("code"), F.size(S.query_fields(fields)).alias("fields"), S.is_citation_only(fields).alias("citation_only"))


@CORE.query("payloads", "SELECT work_id, list_sort(list_filter(json_keys(obj_json), lambda k: k NOT IN ('cookies', 'cookie', 'token', 'password', 'headers'))) AS keys, json_extract_string(obj_json, '$.key') AS object_key FROM judgment_upload_work WHERE obj_json IS NOT NULL AND json_valid(obj_json)")
def payloads(spark, sf):
    """Payloads without what must not be kept; a token is put into each first."""
    p = S.payload(F.regexp_replace("obj_json", r"^\{", '{"token": "abc", "headers": "x", '))
    w = table(spark, sf, "judgment_upload_work").where("obj_json is not null").select("work_id", p.alias("p")).where("p is not null")
    return w.select("work_id", F.array_sort(F.map_keys("p")).alias("keys"), F.try_element_at("p", F.lit("key")).alias("object_key"))


@CORE.query("case_codes", "SELECT page_id, upper(code) AS code FROM (SELECT page_id, regexp_extract(url || '?CaseName=' || (1950 + page_id % 70) || 'Sc' || page_id || '&x=1', 'CaseName=([0-9]{4}[A-Za-z]{1,8}[0-9]{1,6})(?:[^0-9A-Za-z]|$)', 1) AS code FROM page_result) WHERE code <> ''")
def case_codes(spark, sf):
    """Codes of cases in the queries of urls."""
    u = F.concat("url", F.lit("?CaseName="), (1950 + F.col("page_id") % 70).cast("string"), F.lit("Sc"), F.col("page_id").cast("string"), F.lit("&x=1"))
    return table(spark, sf, "page_result").select("page_id", S.case_code(u).alias("code")).where("code is not null")


@CORE.query(
    "public_urls",
    r"""WITH u AS (SELECT page_id, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^http://', 'https://') AS u, lower(regexp_replace(regexp_extract(lower(url), '^https?://([^/:?#]+)', 1), '^www\.', '')) AS h FROM page_result)
    SELECT page_id, CASE WHEN h LIKE '%reports.example' OR h LIKE '%statutes.example' THEN u END AS url, CASE WHEN h LIKE '%reports.example' OR h LIKE '%statutes.example' THEN 'page:' || u || '|' || page_id % 3 END AS query_key FROM u""",
)
def public_urls(spark, sf):
    """Urls in their public form, without fragments and over https, null off the listed hosts, and the key that a document is asked for by."""
    u = F.regexp_replace(F.regexp_replace(F.trim("url"), "#.*$", ""), "^http://", "https://")
    h = U.source_host(F.col("url"))
    listed = h.endswith("reports.example") | h.endswith("statutes.example")
    return table(spark, sf, "page_result").select("page_id", F.when(listed, u).alias("url"), F.when(listed, F.concat(F.lit("page:"), u, F.lit("|"), (F.col("page_id") % 3).cast("string"))).alias("query_key"))


@CORE.query(
    "endpoint_bodies",
    r"""WITH p AS (SELECT page_id, content_type, status, trim(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', ' ', 'g'), '<[^>]*>', ' ', 'g')) AS t FROM page_result),
    w AS (SELECT *, CASE WHEN t = '' THEN 0 ELSE len(string_split_regex(t, '\s+')) END AS words FROM p)
    SELECT page_id, words, CASE WHEN content_type LIKE '%pdf%' THEN 'pdf' WHEN words = 0 THEN 'empty' WHEN words >= 120 THEN 'html_judgment' ELSE 'defer' END AS class FROM w""",
)
def endpoint_bodies(spark, sf):
    """What an address for files has given: a file, nothing, a judgment as a page, or something to ask for again; with the words of the visible text."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>", " "), "<[^>]*>", " "))
    p = table(spark, sf, "page_result").select("page_id", "content_type", F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+"))).alias("words"))
    return p.select("page_id", "words", F.when(F.col("content_type").like("%pdf%"), "pdf").when(F.col("words") == 0, "empty").when(F.col("words") >= 120, "html_judgment").otherwise("defer").alias("class"))


@CORE.query(
    "same_texts",
    """WITH t AS (SELECT doc_id, act_key, trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL AND act_key IS NOT NULL), h AS (SELECT act_key, arg_min(t, doc_id) AS held, min(doc_id) AS hid FROM t GROUP BY 1),
    w AS (SELECT doc_id, hid, ' ' || held || ' ' AS held, string_split(t, ' ') AS w FROM t JOIN h USING (act_key)), r AS (SELECT doc_id, hid, held, list_distinct(list_transform(range(8), lambda i: CAST(floor(i * (len(w) - 12) / 7) AS INTEGER))) AS spots, w FROM w WHERE len(w) >= 12),
    c AS (SELECT doc_id, hid, len(spots) AS runs, len(list_filter(spots, lambda i: contains(held, ' ' || array_to_string(w[i + 1:i + 12], ' ') || ' '))) AS found FROM r)
    SELECT doc_id, hid AS held_id, found, runs, found >= 2 AND found * 2 >= runs AS same FROM c""",
)
def same_texts(spark, sf):
    """Documents against the first document of their act: the share of up to eight evenly spaced runs of twelve words that it has too."""
    d = table(spark, sf, "documents").where("text is not null and act_key is not null").select("doc_id", "act_key", "text")
    held = d.groupBy("act_key").agg(F.min(F.struct("doc_id", "text")).alias("h")).select("act_key", F.col("h.doc_id").alias("held_id"), F.col("h.text").alias("held"))
    j = skew_join(d, held, "act_key", salt_by=F.col("doc_id"))
    s = j.select("doc_id", "held_id", S.in_shingles(F.col("text"), F.col("held")).alias("s")).where("s is not null")
    return s.select("doc_id", "held_id", "s.found", "s.runs", ((F.col("s.found") >= 2) & (F.col("s.found") * 2 >= F.col("s.runs"))).alias("same"))


@CORE.query(
    "grid_accounting",
    f"""WITH e AS (SELECT citation, max_by(reporter, (listed_at, case_id)) AS reporter, max_by(court IS NULL, (listed_at, case_id)) AS courtless FROM enumerated_case WHERE citation IS NOT NULL GROUP BY 1), o AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM judgment j WHERE j.canonical_citation = e.citation))
    SELECT CASE WHEN coalesce(reporter, '') = '' THEN 'no_reporter' WHEN courtless THEN 'no_court' ELSE 'not_held' END AS class, count(*) AS n FROM o GROUP BY 1 UNION ALL SELECT 'held', (SELECT count(*) FROM e) - (SELECT count(*) FROM o)""",
)
def grid_accounting(spark, sf):
    """The latest listing of each citation by what has become of it: held, or why it is not."""
    e = table(spark, sf, "enumerated_case").where("citation is not null").groupBy("citation").agg(F.max(F.struct("listed_at", "case_id", "reporter", F.col("court").isNull().alias("courtless"))).alias("x")).select("citation", "x.reporter", "x.courtless")
    held = table(spark, sf, "judgment").select(F.col("canonical_citation").alias("citation"), F.lit(True).alias("held")).where("citation is not null").distinct()
    cls = F.when(F.col("held"), "held").when(F.coalesce("reporter", F.lit("")) == "", "no_reporter").when(F.col("courtless"), "no_court").otherwise("not_held")
    return e.join(held, "citation", "left").groupBy(cls.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@CORE.query(
    "gap_credit",
    """WITH s AS (SELECT reporter, count(*) AS seen, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM judgment j WHERE j.canonical_citation = e.citation)) AS known, count(*) FILTER (WHERE detail_url IS NULL OR court IS NULL) AS unlinked FROM enumerated_case e GROUP BY 1)
    SELECT reporter, seen, known, greatest(0, least(unlinked, seen - known)) AS credit FROM s""",
)
def gap_credit(spark, sf):
    """Rows of each reporter that are listed, held, and of the rest those that cannot be fetched."""
    held = table(spark, sf, "judgment").select(F.col("canonical_citation").alias("citation"), F.lit(1).alias("held")).where("citation is not null").distinct()
    g = table(spark, sf, "enumerated_case").join(held, "citation", "left").groupBy("reporter").agg(F.count(F.lit(1)).alias("seen"), F.count("held").alias("known"), F.count_if(F.col("detail_url").isNull() | F.col("court").isNull()).alias("unlinked"))
    return g.select("reporter", "seen", "known", F.greatest(F.lit(0), F.least("unlinked", F.col("seen") - F.col("known"))).alias("credit"))


@CORE.query(
    "completeness",
    """WITH p AS (SELECT DISTINCT reporter, decision_year, TRY_CAST(regexp_extract(canonical_citation, '([0-9]+)$', 1) AS INTEGER) AS page_no FROM judgment), g AS (SELECT reporter, page_no - lag(page_no) OVER (PARTITION BY reporter, decision_year ORDER BY page_no) AS step FROM p WHERE page_no IS NOT NULL),
    h AS (SELECT reporter, count(*) FILTER (WHERE step > 60) AS holes, max(step) AS widest FROM g GROUP BY 1), l AS (SELECT reporter, count(*) AS listed FROM enumerated_case GROUP BY 1), j AS (SELECT reporter, count(*) AS held FROM judgment GROUP BY 1)
    SELECT reporter, held, coalesce(listed, 0) AS listed, coalesce(holes, 0) AS holes, widest FROM j LEFT JOIN l USING (reporter) LEFT JOIN h USING (reporter)""",
)
def completeness(spark, sf):
    """What is held and listed of each reporter, and the holes between its pages."""
    from docketry.operators.timelines import gaps

    j = table(spark, sf, "judgment")
    pages = j.select("reporter", "decision_year", F.nullif(F.regexp_extract("canonical_citation", "([0-9]+)$", 1), F.lit("")).try_cast("int").alias("page_no"))
    h = gaps(pages, ["reporter", "decision_year"], "page_no", 0).groupBy("reporter").agg(F.count_if(F.col("before") - F.col("after") > 60).alias("holes"), F.max(F.col("before") - F.col("after")).alias("widest"))
    listed = table(spark, sf, "enumerated_case").groupBy("reporter").agg(F.count(F.lit(1)).alias("listed"))
    held = j.groupBy("reporter").agg(F.count(F.lit(1)).alias("held"))
    return held.join(listed, "reporter", "left").join(h, "reporter", "left").select("reporter", "held", F.coalesce("listed", F.lit(0)).alias("listed"), F.coalesce("holes", F.lit(0)).alias("holes"), "widest")


@CORE.query("unserved_counts", "SELECT coalesce(content_type, '(null)') AS type, count(*) AS n FROM page_result p WHERE coalesce(html, '') = '' AND NOT EXISTS (SELECT 1 FROM page_result o WHERE o.url = p.url AND o.html <> '') GROUP BY 1")
def unserved_counts(spark, sf):
    """Captures without content whose url has none in any other capture, by type."""
    p = table(spark, sf, "page_result").select("url", "content_type", (F.coalesce(F.length("html"), F.lit(0)) > 0).alias("has"))
    good = p.where("has").select("url").where("url is not null").distinct()
    return p.where("not has").join(good, "url", "left_anti").groupBy(F.coalesce("content_type", F.lit("(null)")).alias("type")).agg(F.count(F.lit(1)).alias("n"))


@CORE.query("embedding_state", "SELECT label, count(*) AS n, count(*) FILTER (WHERE embedding IS NULL OR len(embedding) = 0) AS pending, min(vec_id) FILTER (WHERE embedding IS NOT NULL) AS first_done, max(vec_id) FILTER (WHERE embedding IS NOT NULL) AS last_done FROM embeddings GROUP BY 1")
def embedding_state(spark, sf):
    """Rows with and without a vector per label."""
    e = table(spark, sf, "embeddings").select("vec_id", "label", (F.coalesce(F.size("embedding"), F.lit(0)) > 0).alias("done"))
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("done")).alias("pending"), F.min(F.when(F.col("done"), F.col("vec_id"))).alias("first_done"), F.max(F.when(F.col("done"), F.col("vec_id"))).alias("last_done"))


@CORE.query("source_counts", "SELECT source_name, unreported, count(*) AS n FROM judgment GROUP BY ROLLUP (source_name, unreported)")
def source_counts(spark, sf):
    return table(spark, sf, "judgment").rollup("source_name", "unreported").agg(F.count(F.lit(1)).alias("n"))


@CORE.query("group_density", "SELECT reporter, decision_year, count(*) AS held, CAST(row_number() OVER (ORDER BY count(*) DESC, reporter NULLS FIRST, decision_year NULLS FIRST) AS INTEGER) AS place FROM judgment GROUP BY 1, 2 ORDER BY held DESC, reporter NULLS FIRST, decision_year NULLS FIRST LIMIT 40")
def group_density(spark, sf):
    """The forty groups of reporter and year that hold most, in the order in which they are filled."""
    from pyspark.sql import Window

    order = [F.desc("held"), F.asc_nulls_first("reporter"), F.asc_nulls_first("decision_year")]
    top = table(spark, sf, "judgment").groupBy("reporter", "decision_year").agg(F.count(F.lit(1)).alias("held")).orderBy(*order).limit(40)
    return top.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


@CORE.query("pending_frontier", "WITH f AS (SELECT url, count(*) AS attempts, min(fetched_at) AS first_at, bool_or(html <> '') AS done FROM page_result WHERE url IS NOT NULL GROUP BY 1) SELECT url, attempts FROM f WHERE NOT coalesce(done, false) ORDER BY attempts, first_at NULLS FIRST, url LIMIT 50")
def pending_frontier(spark, sf):
    """The fifty urls that are due next: those without content, fewest attempts and oldest first."""
    f = table(spark, sf, "page_result").where("url is not null").groupBy("url").agg(F.count(F.lit(1)).alias("attempts"), F.min("fetched_at").alias("first_at"), F.bool_or(F.col("html") != "").alias("done"))
    return f.where(~F.coalesce("done", F.lit(False))).orderBy("attempts", F.asc_nulls_first("first_at"), "url").limit(50).select("url", "attempts")


@CORE.query("superseded_failures", "SELECT p.page_id FROM page_result p WHERE coalesce(p.html, '') = '' AND EXISTS (SELECT 1 FROM page_result o WHERE o.url = p.url AND o.html <> '' AND o.fetched_at > p.fetched_at)")
def superseded_failures(spark, sf):
    """Failed captures that a later good one of the same url closes: one aggregate per url in place of a self-join."""
    p = table(spark, sf, "page_result").select("page_id", "url", "fetched_at", (F.coalesce(F.length("html"), F.lit(0)) > 0).alias("good"))
    last = p.where("good").groupBy("url").agg(F.max("fetched_at").alias("last_good"))
    return p.where("not good").join(last, "url").where("last_good > fetched_at").select("page_id")


@CORE.query("text_forms", r"""SELECT id, md5(array_to_string(string_split(trim(regexp_replace(replace(full_text, chr(160), ' '), '\s+', ' ', 'g')), ' ')[1:50], ' ')) AS summary, md5(regexp_replace(full_text, '\bO\sR\sD\sE\sR\b', 'ORDER', 'g')) AS spaced FROM judgment WHERE full_text IS NOT NULL AND NOT regexp_matches(full_text, '\bJ\sU\sD\sG')""")
def text_forms(spark, sf):
    """The first fifty words of each text, and its letter-spaced headings put together."""
    t = F.col("full_text")
    return table(spark, sf, "judgment").where(t.isNotNull() & ~t.rlike(r"\bJ\sU\sD\sG")).select("id", F.md5(summary(t, 50)).alias("summary"), F.md5(collapse_letter_spaced(t)).alias("spaced"))


_SOUND = "decision_date IS NOT NULL AND full_text IS NOT NULL"


@CORE.query(
    "dates_in_texts",
    f"""WITH t AS (SELECT id, full_text FROM judgment WHERE {_SOUND}),
    d AS (SELECT id, TRY_CAST(try_strptime(regexp_replace(unnest(regexp_extract_all(full_text, '{D.DAY_FIRST}')), ',', ''), '%d %B %Y') AS DATE) AS day FROM t
      UNION ALL SELECT id, TRY_CAST(try_strptime(unnest(regexp_extract_all(full_text, '{D.MONTH_FIRST}')), '%B %d, %Y') AS DATE) FROM t
      UNION ALL SELECT id, TRY_CAST(try_strptime(regexp_replace(unnest(regexp_extract_all(full_text, '{D.NUMERIC}')), '[/-]', '.', 'g'), '%d.%m.%Y') AS DATE) FROM t
      UNION ALL SELECT id, TRY_CAST(try_strptime(unnest(regexp_extract_all(full_text, '{D.ISO}')), '%Y-%m-%d') AS DATE) FROM t)
    SELECT id, EXISTS (SELECT 1 FROM d WHERE d.id = j.id AND d.day = j.decision_date) AS evidenced FROM judgment j WHERE {_SOUND}""",
)
def dates_in_texts(spark, sf):
    """Whether the date on record stands in the text, in any of the forms in which dates are written."""
    return table(spark, sf, "judgment").where(_SOUND).select("id", D.date_in_text(F.col("decision_date"), F.col("full_text")).alias("evidenced"))


_CAPTION = f"coalesce(nullif(regexp_extract(full_text, {quoted('(?s)' + chr(92) + 'A(.*?)(?m:' + CAPTION_END.removeprefix('(?m)') + ')')}, 1), ''), full_text)"


@CORE.query("captions", f"SELECT id, length({_CAPTION}) AS chars FROM judgment WHERE full_text IS NOT NULL")
def captions(spark, sf):
    """The length of each case's caption, which ends where its order, judgment, coram or judge's line begins."""
    return table(spark, sf, "judgment").where("full_text is not null").select("id", F.length(caption(F.col("full_text"))).alias("chars"))


@CORE.query(
    "case_heads",
    rf"""WITH c AS (SELECT id, {_CAPTION} AS c FROM judgment WHERE full_text IS NOT NULL)
    SELECT id, nullif(regexp_extract(c, '(?m)^\s*([A-Z][A-Za-z. ]{{0,12}}No\. ?[0-9]+\S* of [0-9]{{4}})\s*$', 1), '') AS docket, nullif(regexp_extract(c, '(?i)date of hearing: ?([0-9A-Za-z ,.]+)', 1), '') AS hearing FROM c""",
)
def case_heads(spark, sf):
    """Docket and hearing as the caption gives them."""
    return table(spark, sf, "judgment").where("full_text is not null").select("id", case_head(F.col("full_text")).alias("h")).select("id", "h.docket", "h.hearing")


@CORE.query(
    "contents_lists",
    r"""WITH l AS (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^\s+|\s+$', '', 'g') AS x FROM documents WHERE text IS NOT NULL), e AS (SELECT doc_id, regexp_extract(x, '^(\d{1,4}[A-Z]?(?:-[A-Z])?)[.)]\s+(.+?)(?:[\s.]{4,}(\d{1,4}))?\s*$', ['number', 'heading', 'page']) AS m FROM l WHERE regexp_matches(x, '^\d{1,4}[A-Z]?(?:-[A-Z])?[.)]\s+.'))
    SELECT doc_id, count(*) AS entries, count(nullif(m.page, '')) AS with_page, count(*) FILTER (WHERE regexp_matches(m.heading, '(?i)\b(omitted|repealed|deleted)\b')) AS omitted FROM e GROUP BY 1""",
)
def contents_lists(spark, sf):
    """Lines of documents that read as entries of a contents list."""
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", F.explode(contents_entries(F.col("text"))).alias("e"))
    return d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("entries"), F.count("e.page").alias("with_page"), F.count_if("e.omitted").alias("omitted"))


def _clean_sql(column: str) -> str:
    junk = re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", JUNK)
    out = f"regexp_replace({column}, {quoted(junk)}, '', 'g')"
    out = f"regexp_replace(translate({out}, chr(160) || chr(9), '  '), '\\r\\n?', chr(10), 'g')"
    out = f"regexp_replace(regexp_replace({out}, ' {{2,}}', ' ', 'g'), '(?m)^ +| +$', '', 'g')"
    return f"regexp_replace(regexp_replace({out}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"


@CORE.query("cleaned_texts", f"SELECT id, md5({_clean_sql('full_text')}) AS text FROM judgment WHERE full_text IS NOT NULL")
def cleaned_texts(spark, sf):
    """Texts without control characters, with blanks and blank lines collapsed."""
    return table(spark, sf, "judgment").where("full_text is not null").select("id", F.md5(clean_text(F.col("full_text"))).alias("text"))


@CORE.query("best_bodies", "SELECT m.case_id, CASE WHEN length(trim(coalesce(full_text, ''))) >= 200 AND length(trim(coalesce(full_text, ''))) > length(trim(coalesce(headnotes, ''))) THEN length(full_text) ELSE length(coalesce(headnotes, full_text)) END AS chars FROM case_metadata m JOIN judgment j ON j.id = m.judgment_id")
def best_bodies(spark, sf):
    """Of headnotes and full text the one that is fit to be the body."""
    j = table(spark, sf, "judgment").select(F.col("id").alias("judgment_id"), "full_text")
    return table(spark, sf, "case_metadata").join(j, "judgment_id").select("case_id", F.length(best_body(F.col("headnotes"), F.col("full_text"))).alias("chars"))


@CORE.query("volume_cases")
def volume_cases(spark, sf):
    """Cases of documents read as volumes: of the same parties the longest text."""
    return split_volumes(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id", "petitioner", "respondent", "line", F.length("body").alias("chars"))


@CORE.query("title_similarity")
def title_similarity(spark, sf):
    """How alike the title of a judgment and that of its case record are."""
    m = table(spark, sf, "case_metadata").where("petitioner is not null and respondent is not null").select("case_id", F.col("judgment_id").alias("id"), F.concat_ws(" v. ", "petitioner", "respondent").alias("t"))
    return m.join(table(spark, sf, "judgment").select("id", "case_title"), "id").select("case_id", similarity(F.col("case_title"), F.col("t")).alias("similarity"))


@CORE.query(
    "mirror_states",
    """WITH a AS (SELECT id AS k, octet_length(encode(full_text)) AS n FROM judgment WHERE full_text IS NOT NULL), b AS (SELECT judgment_id AS k, max(CAST(json_extract_string(obj_json, '$.bytes') AS BIGINT)) AS n FROM judgment_upload_work WHERE judgment_id IS NOT NULL GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS id, CASE WHEN a.k IS NULL THEN 'unlisted' WHEN b.k IS NULL THEN 'missing' WHEN a.n IS NOT DISTINCT FROM b.n THEN 'ok' ELSE 'mismatch' END AS state FROM a FULL JOIN b ON a.k = b.k""",
)
def mirror_states(spark, sf):
    """The judgments against the ledger of what was uploaded: ok, missing, mismatch by size, or unlisted."""
    a = table(spark, sf, "judgment").where("full_text is not null").select("id", F.octet_length("full_text").cast("bigint").alias("n"))
    b = table(spark, sf, "judgment_upload_work").where("judgment_id is not null").groupBy(F.col("judgment_id").alias("id")).agg(F.max(F.get_json_object("obj_json", "$.bytes").cast("bigint")).alias("n"))
    return mirror(a, b, "id", "n")


@CORE.query("stored_once", "SELECT 1 AS pass, count(DISTINCT sha256(html)) AS stored FROM page_result WHERE html <> '' UNION ALL SELECT 2, 0")
def stored_once(spark, sf):
    """How many captures are new to a store that is written twice."""
    target = f"{ensure_checkpoint_dir(spark)}/stores/{uuid.uuid4().hex}"
    p = table(spark, sf, "page_result").where("html <> ''").select(F.sha2("html", 256).alias("content_hash"), "source_name")
    return spark.createDataFrame([(n, write_once(p, target, "content_hash", ["source_name"])) for n in (1, 2)], "pass int, stored bigint")
