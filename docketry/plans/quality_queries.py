"""Hashing, duplicates, text quality, HTML, urls and secrets."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.functions import text as T
from docketry.functions import urls as U
from docketry.operators.dedupe import exact_duplicates, longest_wins, provenance
from docketry.operators.sections import is_fake_number, missing_in_run
from docketry.operators.skew import skew_join
from docketry.plans.registry import CORE, quoted
from docketry.sources.tables import table

_COLLAPSE = "trim(regexp_replace(replace({0}, chr(160), ' '), '\\s+', ' ', 'g'))"


@CORE.query("canonical_hashes", f"SELECT doc_id, sha256({_COLLAPSE.format('text')}) AS text_hash FROM documents")
def canonical_hashes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.canonical_text_hash(F.col("text")).alias("text_hash"))


@CORE.query("exact_duplicates", f"SELECT sha256({_COLLAPSE.format('text')}) AS key, count(*) AS copies, min(doc_id) AS keeper FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def exact_duplicate_groups(spark, sf):
    return exact_duplicates(table(spark, sf, "documents"), "doc_id", T.canonical_text_hash(F.col("text")))


@CORE.query("insert_if_absent", "SELECT min(page_id) AS page_id, source_name, sha256(html) AS content_hash FROM page_result WHERE html <> '' GROUP BY 2, 3")
def insert_if_absent(spark, sf):
    """The first capture of each content of a source: what an insert-if-absent keeps."""
    p = table(spark, sf, "page_result").where("html <> ''").select("page_id", "source_name", F.sha2("html", 256).alias("content_hash"))
    return p.groupBy("source_name", "content_hash").agg(F.min("page_id").alias("page_id"))


@CORE.query(
    "provenance_merge",
    "SELECT source_name, sha256(html) AS content_hash, list_sort(list(DISTINCT url)) AS routes, min(fetched_at) AS first_seen, max(fetched_at) AS last_seen, count(*) AS captures FROM page_result WHERE html <> '' GROUP BY 1, 2",
)
def provenance_merge(spark, sf):
    p = table(spark, sf, "page_result").where("html <> ''").select("source_name", F.sha2("html", 256).alias("content_hash"), "url", "fetched_at")
    return provenance(p, ["source_name", "content_hash"], "url", "fetched_at")


_FIRST_LINE = "regexp_replace(lower(split_part(coalesce(text, ''), chr(10), 1)), '[^a-z0-9]', '', 'g')"


def _named(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.name_key(F.split_part(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(1))).alias("name_key")).where("name_key <> ''")


@CORE.query("name_key_groups", f"SELECT {_FIRST_LINE} AS name_key, count(*) AS n, min(doc_id) AS group_id FROM documents GROUP BY 1 HAVING count(*) > 1 AND name_key <> ''")
def name_key_groups(spark, sf):
    """Names that the first lines of several documents share: the key, its documents and the smallest of them, aggregated before the shuffle."""
    return _named(spark, sf).groupBy("name_key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("group_id")).where("n > 1")


@CORE.query("name_key_members", f"SELECT doc_id, group_id FROM (SELECT doc_id, {_FIRST_LINE} AS k, count(*) OVER (PARTITION BY k) AS n, min(doc_id) OVER (PARTITION BY k) AS group_id FROM documents) WHERE n > 1 AND k <> ''")
def name_key_members(spark, sf):
    """The documents of the groups, one row each: a common first line is never gathered in one row."""
    return skew_join(_named(spark, sf), name_key_groups(spark, sf), "name_key", salt_by=F.col("doc_id")).select("doc_id", "group_id")


@CORE.query(
    "longest_text_wins",
    "SELECT work FROM (SELECT id AS work, row_number() OVER (PARTITION BY docket_key ORDER BY length(full_text) DESC NULLS LAST, id) AS rn, docket_key FROM judgment) WHERE rn = 1 OR docket_key IS NULL",
)
def longest_text_wins(spark, sf):
    j = table(spark, sf, "judgment").select("id", "docket_key", F.coalesce(F.length("full_text"), F.lit(-1)).alias("n"))
    return longest_wins(j, "docket_key", F.col("n"), "id").select(F.col("id").alias("work"))


_REAL = "list_sort(list_distinct(list_filter(nums, lambda n: n IS NOT NULL AND n NOT BETWEEN 1800 AND 2100 AND n <= 5000)))"


@CORE.query(
    "missing_in_run",
    f"""WITH s AS (SELECT statute_id, list(TRY_CAST(nullif(regexp_extract(section_number, '^([0-9]{{1,9}})', 1), '') AS INTEGER)) AS nums FROM (SELECT DISTINCT statute_id, section_number FROM statute_section_version) GROUP BY 1),
    r AS (SELECT statute_id, {_REAL} AS present FROM s)
    SELECT statute_id, len(present) AS sections, coalesce(list_max(present), 0) AS run_end, CASE WHEN len(present) = 0 OR list_max(present) <= 0 THEN 10000 ELSE list_max(present) - len(list_filter(present, lambda n: n BETWEEN 1 AND list_max(present))) END AS missing FROM r""",
)
def missing_in_runs(spark, sf):
    """Numbers that are absent from each statute's run of sections."""
    from docketry.functions.legal import section_integer
    from docketry.operators.sections import real_numbers

    v = table(spark, sf, "statute_section_version").select("statute_id", "section_number").distinct()
    s = v.groupBy("statute_id").agg(F.collect_list(section_integer(F.col("section_number"))).alias("nums"))
    end = F.coalesce(F.array_max(real_numbers(F.col("nums"))), F.lit(0))
    return s.select("statute_id", F.size(real_numbers(F.col("nums"))).alias("sections"), end.alias("run_end"), missing_in_run(F.col("nums"), end).alias("missing"))


@CORE.query(
    "fake_section_numbers",
    f"""WITH d AS (SELECT DISTINCT statute_id, section_number, TRY_CAST(nullif(regexp_extract(section_number, '^([0-9]{{1,9}})', 1), '') AS INTEGER) AS n FROM statute_section_version),
    s AS (SELECT statute_id, list(n) AS nums FROM d GROUP BY 1), r AS (SELECT statute_id, {_REAL} AS present FROM s),
    o AS (SELECT d.*, list_filter(present, lambda x: x <> n) AS others FROM d JOIN r USING (statute_id))
    SELECT statute_id, section_number, n FROM o WHERE n IS NOT NULL AND (n BETWEEN 1800 AND 2100 OR n > 5000 OR (n >= 100 AND n > 5 + CASE WHEN len(others) = 0 THEN 0 WHEN len(others) = 1 THEN others[1] ELSE greatest(others[len(others) // 2 + 1], others[len(others) - 1]) END))""",
)
def fake_section_numbers(spark, sf):
    """Section numbers that are years or far off the others of their statute. The numbers of a statute are few, its captures need not be."""
    from docketry.functions.legal import section_integer

    d = table(spark, sf, "statute_section_version").select("statute_id", "section_number").distinct().withColumn("n", section_integer(F.col("section_number")))
    s = d.groupBy("statute_id").agg(F.collect_list("n").alias("nums"))
    return d.join(s, "statute_id").where(F.col("n").isNotNull() & is_fake_number(F.col("n"), F.col("nums"))).select("statute_id", "section_number", "n")


@CORE.query(
    "ocr_quality",
    f"""SELECT doc_id, round(coalesce(len(regexp_extract_all(text, '\\p{{L}}')) / nullif(length(text), 0), 0), 6) AS letter_ratio, round(coalesce(len(regexp_extract_all(text, {quoted(T.MOJIBAKE)})) / nullif(length(text), 0), 0), 6) AS mojibake_density,
      round(coalesce((length(text) - length(regexp_replace(text, '[A-Za-z]{{4,}}', '', 'g'))) / nullif(length(text), 0), 0), 6) AS long_word_share, coalesce(regexp_matches(text, '\\?{{4,}}'), false) AS mojibake_run FROM documents WHERE text IS NOT NULL""",
)
def ocr_quality(spark, sf):
    d = table(spark, sf, "documents").where("text is not null")
    t = F.col("text")
    return d.select("doc_id", F.round(T.letter_ratio(t), 6).alias("letter_ratio"), F.round(T.mojibake_density(t), 6).alias("mojibake_density"), F.round(T.long_word_share(t), 6).alias("long_word_share"), T.has_mojibake_run(t).alias("mojibake_run"))


_BODY = "trim(coalesce(section_text, ''))"


@CORE.query(
    "failing_sections",
    f"""WITH b AS (SELECT id, statute_id, {_BODY} AS body FROM statute_section_version),
    m AS (SELECT *, length(body) AS n, len(regexp_extract_all(body, '\\p{{L}}')) / greatest(length(body), 1) AS letters, len(regexp_extract_all(body, '[0-9]')) / greatest(length(body), 1) AS digits,
      len(regexp_extract_all(body, {quoted(T.MOJIBAKE)})) / greatest(length(body), 1) AS moji, len(regexp_extract_all(body, chr(65533))) AS lost FROM b),
    f AS (SELECT *, n >= 40 AND (moji >= 0.012 OR letters < CASE WHEN regexp_matches(body, {quoted(T.SCHEDULE)}) AND digits > 0.08 THEN 0.12 ELSE 0.28 END OR lost >= 3) AS fails FROM m)
    SELECT statute_id, count(*) AS sections, count(*) FILTER (WHERE fails) AS failing, count(*) FILTER (WHERE fails) > 0.5 * count(*) AS poor FROM f GROUP BY 1""",
)
def failing_sections(spark, sf):
    """Sections that fail the quality rules per statute, and statutes of which most fail."""
    v = table(spark, sf, "statute_section_version").select("statute_id", T.fails_ocr_quality(F.col("section_text")).alias("fails"))
    return v.groupBy("statute_id").agg(F.count(F.lit(1)).alias("sections"), F.count_if("fails").alias("failing"), (F.count_if("fails") > 0.5 * F.count(F.lit(1))).alias("poor"))


_LONG = "(length(b) - length(regexp_replace(b, '[A-Za-z]{4,}', '', 'g')))"
_LETTERS = f"len(regexp_extract_all(b, {quoted(rf'[\p{{L}}{T.ARABIC}{T.PRIVATE}]')}))"
_SCRIPT = f"len(regexp_extract_all(b, {quoted(f'[{T.ARABIC}{T.PRIVATE}]')}))"


@CORE.query(
    "garbled_documents",
    rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS r, trim(coalesce(text, '')) AS b FROM documents),
    m AS (SELECT *, {_LETTERS} >= 8 AND {_SCRIPT} >= 0.5 * {_LETTERS} AS arabic, regexp_matches(b, {quoted(T.SCHEDULE)}) AND len(regexp_extract_all(b, '[0-9]')) > 0.08 * length(b) AS schedule,
      len(regexp_extract_all(r, {quoted(T.READABLE)})) AS readable, len(regexp_extract_all(r, '[\p{{C}}\p{{Z}}]')) - len(regexp_extract_all(r, {quoted(f'[ {T.PRIVATE}]')})) AS odd FROM t)
    SELECT doc_id, length(b) >= 80 AND NOT arabic AND NOT schedule AND 1 - {_LONG} / length(b) > 0.75 AS garbled, arabic,
      arabic OR (length(b) >= 40 AND {_LONG} >= 12 AND 1 - {_LONG} / length(b) <= 0.75) AS readable,
      regexp_matches(r, '\S') AND (contains(left(r, 32), {quoted(T.JPEG_HEAD)}) OR starts_with(r, {quoted(T.PNG_HEAD)}) OR readable < length(r) * CASE WHEN regexp_matches(r, {quoted(T.IMAGE_NAMES)}) THEN 0.85 WHEN length(r) >= 8 THEN 0.5 ELSE 0 END
        OR (length(r) >= 32 AND odd > 0.2 * length(r))) AS binary FROM m""",
)
def garbled_documents(spark, sf):
    """Garbled, binary, readable and Arabic-script verdicts of documents."""
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", T.is_garbled(t).alias("garbled"), T.is_binary_garbage(t).alias("binary"), T.is_arabic_script(F.trim(F.coalesce(t, F.lit("")))).alias("arabic"), T.has_readable_words(t).alias("readable"))


@CORE.query(
    "script_share",
    "SELECT lang, count(*) AS n, count(*) FILTER (WHERE len(regexp_extract_all(text, '[\\x{0600}-\\x{06FF}]')) * 2 > length(text)) AS mostly_arabic, round(avg(len(regexp_extract_all(text, '\\p{L}')) / length(text)), 6) AS mean_letters FROM documents WHERE length(text) > 0 GROUP BY 1",
)
def script_share(spark, sf):
    d = table(spark, sf, "documents").where("length(text) > 0")
    arabic = F.regexp_count("text", F.lit(r"[\x{0600}-\x{06FF}]")) * 2 > F.length("text")
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(arabic).alias("mostly_arabic"), F.round(F.avg(T.letter_ratio(F.col("text"))), 6).alias("mean_letters"))


@CORE.query(
    "section_noise",
    """SELECT id, CASE WHEN trim(section_text) = '' THEN 'empty' WHEN regexp_matches(section_text, '^\\s*[0-9]{1,4}\\s*\\.?\\s*$') THEN 'page_only' WHEN regexp_matches(section_text, '(?i)(printed (at|by)|published by|government press)') AND length(section_text) < 220 THEN 'imprint'
      WHEN regexp_matches(section_text, '^[0-9]{1,2}\\.[0-9]{1,2}\\.[0-9]{4}') THEN 'date_headed' ELSE 'text' END AS kind FROM statute_section_version WHERE section_text IS NOT NULL""",
)
def section_noise(spark, sf):
    t = F.col("section_text")
    kind = F.when(F.trim(t) == "", "empty").when(t.rlike(r"^\s*[0-9]{1,4}\s*\.?\s*$"), "page_only").when(t.rlike("(?i)(printed (at|by)|published by|government press)") & (F.length(t) < 220), "imprint").when(t.rlike(r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"), "date_headed").otherwise("text")
    return table(spark, sf, "statute_section_version").where(t.isNotNull()).select("id", kind.alias("kind"))


def _html_sql() -> str:
    out = "coalesce(html, '')"
    for tag in ("script", "style", "noscript", "header", "footer", "nav", "iframe"):
        out = f"regexp_replace({out}, '(?is)<{tag}(\\s[^>]*)?>.*?</{tag}\\s*>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?s)<!--.*?-->', ' ', 'g')"
    out = f"regexp_replace({out}, '(?i)<br\\s*/?>|</p>|</div>|</tr>|</li>|</h[1-6]>', chr(10), 'g')"
    out = f"regexp_replace({out}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    out = f"regexp_replace({out}, '[ \\t]+', ' ', 'g')"
    out = f"regexp_replace({out}, ' ?\\n ?', chr(10), 'g')"
    return f"regexp_replace(regexp_replace({out}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"


@CORE.query("html_to_text", f"SELECT page_id, {_html_sql()} AS text FROM page_result")
def html_to_text(spark, sf):
    return table(spark, sf, "page_result").select("page_id", U.html_to_text(F.col("html")).alias("text"))


@CORE.query("page_links", """SELECT page_id, regexp_extract(a, '(?is)href="([^"]*)"', 1) AS href, trim(regexp_replace(a, '(?s)<[^>]*>', '', 'g')) AS label FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href="[^"]*"[^>]*>.*?</a>')) AS a FROM page_result)""")
def page_links(spark, sf):
    """Every anchor of every page."""
    return table(spark, sf, "page_result").select("page_id", F.explode(U.page_links(F.col("html"))).alias("l")).select("page_id", "l.href", "l.label")


@CORE.query(
    "links_to_cases",
    """SELECT page_id, list_sort(list(DISTINCT href)) AS cases FROM (SELECT page_id, regexp_extract(a, '(?is)href="([^"]*)"', 1) AS href FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href="[^"]*"[^>]*>.*?</a>')) AS a FROM page_result)) WHERE href LIKE '/case/%' GROUP BY 1""",
)
def links_to_cases(spark, sf):
    """The distinct links of a page that match a hint."""
    hrefs = F.array_distinct(F.filter(F.transform(U.page_links(F.col("html")), lambda x: x["href"]), lambda h: h.startswith("/case/")))
    return table(spark, sf, "page_result").select("page_id", F.array_sort(hrefs).alias("cases")).where(F.size("cases") > 0)


@CORE.query("hosts", "SELECT regexp_replace(regexp_extract(lower(url), '^https?://([^/:?#]+)', 1), '^www\\.', '') AS host, count(*) AS pages, count(DISTINCT url) AS urls FROM page_result WHERE url IS NOT NULL GROUP BY 1")
def hosts(spark, sf):
    p = table(spark, sf, "page_result").where("url is not null").select(U.source_host(F.col("url")).alias("host"), "url")
    return p.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.count_distinct("url").alias("urls"))


@CORE.query(
    "responses",
    """SELECT page_id, CASE WHEN regexp_matches(lower(coalesce(url, '')), '/login|/signin') THEN 'login' WHEN regexp_matches(lower(coalesce(html, '')), 'captcha|are you a robot') THEN 'captcha' WHEN regexp_matches(lower(coalesce(html, '')), 'already logged in|session (has )?expired') THEN 'login'
      WHEN status IN (401, 403, 429) OR regexp_matches(lower(coalesce(html, '')), 'access denied|too many requests') THEN 'block' WHEN status >= 400 THEN 'error' WHEN length(trim(coalesce(html, ''))) = 0 THEN 'empty' ELSE 'ok' END AS verdict,
      CASE WHEN status < 400 THEN 'ok' WHEN status IN (400, 401, 403, 404, 410) THEN 'retire' ELSE 'defer' END AS action FROM page_result""",
)
def responses(spark, sf):
    return table(spark, sf, "page_result").select("page_id", U.classify_response(F.col("status"), F.col("html"), F.col("url")).alias("verdict"), U.status_action(F.col("status")).alias("action"))


@CORE.query("url_policy", "SELECT page_id, CASE WHEN NOT regexp_matches(lower(url), '^https?://') THEN 'scheme' WHEN NOT (regexp_extract(lower(url), '^https?://([^/:?#]+)', 1) LIKE '%statutes.example' OR regexp_extract(lower(url), '^https?://([^/:?#]+)', 1) LIKE '%law.example') THEN 'host' END AS violation FROM page_result")
def url_policy(spark, sf):
    p = table(spark, sf, "page_result").select("page_id", "url", U.source_host(F.col("url")).alias("h"))
    allow = F.col("h").endswith("statutes.example") | F.col("h").endswith("law.example")
    bad = U.url_violation(F.col("url"), [])
    return p.select("page_id", F.when((bad == "host") & allow, F.lit(None)).otherwise(bad).alias("violation"))


@CORE.query("backoff", "SELECT DISTINCT attempts, CAST(least(86400, 300 * pow(2, least(greatest(attempts, 1) - 1, 6))) AS INTEGER) AS seconds FROM (SELECT l_linenumber AS attempts FROM lineitem)")
def backoff(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("attempts")).distinct().select("attempts", U.backoff_seconds(F.col("attempts")).alias("seconds"))


@CORE.query("secret_flags", "SELECT work_id, " + " OR ".join(f"coalesce(regexp_matches(obj_json, {quoted(x)}), false)" for x in T.secret_shapes()) + " AS has_secret FROM judgment_upload_work")
def secret_flags(spark, sf):
    return table(spark, sf, "judgment_upload_work").select("work_id", T.contains_secret(F.col("obj_json")).alias("has_secret"))


def _scrubbed(column: str) -> str:
    for x in T.secret_shapes():
        column = f"regexp_replace({column}, {quoted(x)}, '\\1[REDACTED]', 'g')"
    return column


@CORE.query("secrets_scrubbed", f"SELECT work_id, {_scrubbed('said')} AS said FROM (SELECT work_id, concat('Authorization: Bearer ', work_id, '.abc', chr(10), 'csrf_token=', target_id, '&page=2 sid: ', replace(target_id, '-', ''), ' ', obj_json) AS said FROM judgment_upload_work)")
def secrets_scrubbed(spark, sf):
    """Payloads behind a login header and tokens, with the secrets taken out."""
    said = F.concat(F.lit("Authorization: Bearer "), F.col("work_id").cast("string"), F.lit(".abc\ncsrf_token="), F.col("target_id"), F.lit("&page=2 sid: "), F.replace("target_id", F.lit("-"), F.lit("")), F.lit(" "), F.col("obj_json"))
    return table(spark, sf, "judgment_upload_work").select("work_id", T.scrub_secrets(said).alias("said"))


@CORE.query("payload_fields", "SELECT work_id, json_extract_string(obj_json, '$.key') AS object_key, CAST(json_extract_string(obj_json, '$.bytes') AS BIGINT) AS bytes, coalesce(CAST(json_extract_string(obj_json, '$.retry') AS INTEGER), 0) AS retry FROM judgment_upload_work")
def payload_fields(spark, sf):
    """Fields of a JSON payload."""
    get = lambda k: F.get_json_object("obj_json", f"$.{k}")
    return table(spark, sf, "judgment_upload_work").select("work_id", get("key").alias("object_key"), get("bytes").cast("bigint").alias("bytes"), F.coalesce(get("retry").cast("int"), F.lit(0)).alias("retry"))
