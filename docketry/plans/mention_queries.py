"""Listings, mentions with spans, relations between instruments, lines and titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.functions import lines as N
from docketry.functions import spans as S
from docketry.functions.legal import best_treatment, section_integer
from docketry.operators.identity import resolve_unique
from docketry.operators.timelines import number_gaps
from docketry.plans.registry import CORE, quoted
from docketry.sources.tables import table

_ROW = "(?is)<tr>\\s*<td>([^<]*)</td>\\s*<td><a href=\"([^\"]*)\">([^<]*)</a></td>\\s*<td>([^<]*)</td>\\s*</tr>"


@CORE.query(
    "listing_rows",
    "WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<tr>\\s*<td>[^<]*</td>\\s*<td><a href=\"[^\"]*\">[^<]*</a></td>\\s*<td>[^<]*</td>\\s*</tr>')) AS r FROM page_result) "
    f"SELECT page_id, regexp_extract(r, '{_ROW}', 1) AS citation, regexp_extract(r, '{_ROW}', 2) AS href, regexp_extract(r, '{_ROW}', 3) AS title, regexp_extract(r, '{_ROW}', 4) AS court FROM r",
)
def listing_rows(spark, sf):
    """The rows of listing pages as typed fields."""
    whole = F.regexp_extract_all("html", F.lit("(?is)(<tr>\\s*<td>[^<]*</td>\\s*<td><a href=\"[^\"]*\">[^<]*</a></td>\\s*<td>[^<]*</td>\\s*</tr>)"), F.lit(1))
    r = table(spark, sf, "page_result").select("page_id", F.explode(whole).alias("r"))
    return r.select("page_id", *[F.regexp_extract("r", _ROW, i).alias(c) for i, c in enumerate(("citation", "href", "title", "court"), 1)])


@CORE.query("listing_totals", "SELECT page_id, TRY_CAST(replace(regexp_extract(html, '([0-9][0-9,]*) (?:cases|records|results) found', 1), ',', '') AS INTEGER) AS total, len(regexp_extract_all(html, '<td><a href=\"/case/')) AS rows FROM page_result WHERE regexp_matches(html, '[0-9] (?:cases|records|results) found')")
def listing_totals(spark, sf):
    """The total that a listing names beside the rows it shows."""
    p = table(spark, sf, "page_result").where(F.col("html").rlike("[0-9] (?:cases|records|results) found"))
    total = F.regexp_replace(F.regexp_extract("html", "([0-9][0-9,]*) (?:cases|records|results) found", 1), ",", "").try_cast("int")
    return p.select("page_id", total.alias("total"), F.regexp_count("html", F.lit('<td><a href="/case/')).alias("rows"))


@CORE.query("case_ids", "SELECT page_id, TRY_CAST(regexp_extract(url, '/([0-9]+)$', 1) AS BIGINT) AS serial, regexp_extract(url, 'https?://[^/]+/([a-z.]+)', 1) AS route FROM page_result WHERE url IS NOT NULL")
def case_ids(spark, sf):
    p = table(spark, sf, "page_result").where("url is not null")
    return p.select("page_id", F.regexp_extract("url", "/([0-9]+)$", 1).try_cast("bigint").alias("serial"), F.regexp_extract("url", "https?://[^/]+/([a-z.]+)", 1).alias("route"))


@CORE.query("next_serials", "WITH s AS (SELECT source_name, TRY_CAST(regexp_extract(url, '/([0-9]+)$', 1) AS BIGINT) AS n FROM page_result), d AS (SELECT DISTINCT source_name, n FROM s WHERE n IS NOT NULL), l AS (SELECT source_name, n, lead(n) OVER (PARTITION BY source_name ORDER BY n) AS nxt FROM d) SELECT source_name, min(n + 1) AS next_free, count(*) AS gaps FROM l WHERE nxt IS NULL OR nxt > n + 1 GROUP BY 1")
def next_serials(spark, sf):
    """The next serial of each source that is not held, and how many runs the held ones form."""
    s = table(spark, sf, "page_result").select("source_name", F.regexp_extract("url", "/([0-9]+)$", 1).try_cast("bigint").alias("n"))
    return number_gaps(s, "source_name", "n").groupBy("source_name").agg(F.min(F.col("after") + 1).alias("next_free"), F.count(F.lit(1)).alias("gaps"))


@CORE.query("citation_spans")
def citation_spans(spark, sf):
    """Every citation of every judgment with its span, its sentence and how the sentence treats it."""
    j = table(spark, sf, "judgment").select("id", "full_text", F.explode(S.citation_spans(F.col("full_text"))).alias("c")).select("id", "full_text", "c.*")
    said = S.sentence(F.col("full_text"), F.col("start"), F.col("end"))
    near = S.passage(F.col("full_text"), F.col("start"), F.col("end"))
    return j.select("id", "family", "year", "court", "page", "start", "end", F.coalesce(best_treatment(said).getField("label"), best_treatment(near).getField("label")).alias("treatment"))


@CORE.query("bound_sections")
def bound_sections(spark, sf):
    """Section references with the statute they belong to, counted."""
    v = table(spark, sf, "statute_section_version").select(F.explode(S.statute_spans(F.col("section_text"))).alias("r")).select("r.*")
    return v.groupBy("kind", "statute", "bound_by").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("number").alias("numbers"))


_WITH = "(?:read with|amended by|superseded by) (?:the )?((?:[A-Z][a-z]+ )+(?:and [A-Z][a-z]+ )?(?:\\([A-Z][a-z]+(?: [A-Z][a-z]+)?\\) )?(?:Act|Ordinance|Order|Rules|Regulations), [0-9]{4})"


@CORE.query(
    "instrument_relations",
    f"""WITH m AS (SELECT id, unnest(list_distinct(regexp_extract_all(full_text, '{_WITH}', 1))) AS named FROM instrument), s AS (SELECT name, min(id) AS low, max(id) AS high FROM statute GROUP BY 1)
    SELECT m.id, m.named, CASE WHEN low = high THEN low END AS resolved_id, CASE WHEN low IS NULL THEN 'unresolved' WHEN low = high THEN 'linked' ELSE 'ambiguous' END AS resolution FROM m LEFT JOIN s ON s.name = m.named""",
)
def instrument_relations(spark, sf):
    """Statutes that instruments are to be read with, each resolved to the one statute of that name."""
    i = table(spark, sf, "instrument").select("id", F.explode(F.array_distinct(F.regexp_extract_all("full_text", F.lit(_WITH), F.lit(1)))).alias("named"))
    return resolve_unique(i, "named", table(spark, sf, "statute").select(F.col("id").alias("sid"), "name"), ["name"], "sid")


@CORE.query("amendment_clauses")
def amendment_clauses(spark, sf):
    """Amending clauses of instruments and sections: operation, section and statute, with the place of the first of equal ones."""

    def of(name, text):
        return table(spark, sf, name).select(F.lit(name).alias("source_table"), "id", F.col(text).alias("t"))

    texts = of("instrument", "full_text").unionByName(of("statute_section_version", "section_text"))
    # every operation has one of these words in it
    found = texts.where(F.col("t").rlike("(?i)inserted|substituted|omitted|repealed|added|deleted")).select("source_table", "id", F.explode(S.amendments(F.col("t"))).alias("a")).select("source_table", "id", "a.*")
    return found.groupBy("source_table", "id", "operation", "number", "statute").agg(F.min("start").alias("start"))


_LINES = "string_split(replace({0}, chr(13) || chr(10), chr(10)), chr(10))"
_LINE_CLASS = (
    f"CASE WHEN trim(regexp_replace(x, '\\s+', ' ', 'g')) = '' THEN 'B' WHEN regexp_matches(x, {quoted(N.RUN)}) THEN CASE WHEN regexp_matches(x, {quoted(N.SIGNED)}) OR len(regexp_extract_all(x, {quoted(N.SHORT_WORDS)})) >= 3 "
    f"OR regexp_matches(x, {quoted(N.LONG_WORD)}) OR length(regexp_replace(x, '[?\\s]', '', 'g')) > {N.REMAINS} THEN 'D' ELSE 'Q' END WHEN regexp_matches(x, {quoted(N.SIGNED)}) THEN 'S' WHEN regexp_matches(x, {quoted(N.SHORT_WORDS)}) THEN 'L' WHEN regexp_matches(x, {quoted(N.ARABIC_BLOCK)}) THEN 'U' ELSE 'O' END"
)


def _classes(column: str) -> str:
    return f"array_to_string(list_transform({_LINES.format(column)}, lambda x: {_LINE_CLASS}), '')"



@CORE.query(
    "mojibake_classes",
    f"SELECT CASE WHEN text IS NULL OR NOT regexp_matches(text, {quoted(N.RUN)}) THEN 'none' WHEN regexp_matches({_classes('text')}, {quoted(N.LOST_TAIL)}) THEN 'headnote' ELSE 'body' END AS kind, count(*) AS n FROM documents GROUP BY 1",
)
def mojibake_classes(spark, sf):
    """Where the lost characters of a text are."""
    d = table(spark, sf, "documents").select(N.mojibake_class(F.col("text")).alias("kind"))
    return d.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@CORE.query(
    "lost_tails",
    rf"""WITH t AS (SELECT id, full_text || chr(10) || 'J.' || chr(10) || '?????? ???' || chr(10) || 'The ????? order ran to ????' || chr(10) || '????' AS t FROM judgment WHERE full_text IS NOT NULL), c AS (SELECT *, {_LINES.format('t')} AS l, {_classes('t')} AS k FROM t)
    SELECT id, '…' || right(regexp_replace(array_to_string(list_filter(l, lambda x, i: i <= length(regexp_extract(k, '^(.*S)?')) OR NOT ({_LINE_CLASS}) IN ('Q', 'U', 'B')), chr(10)), '\s+$', ''), 60) AS tail FROM c""",
)
def lost_tails(spark, sf):
    """How judgments end once the lost lines behind their signatures are taken off; each is given a signed tail with lost and damaged lines."""
    t = F.concat("full_text", F.lit("\nJ.\n?????? ???\nThe ????? order ran to ????\n????"))
    return table(spark, sf, "judgment").where("full_text is not null").select("id", F.concat(F.lit("…"), F.right(N.strip_lost_tail(t), F.lit(60))).alias("tail"))


@CORE.query(
    "instrument_bodies",
    rf"""WITH l AS (SELECT id, full_text, string_split(replace(full_text, chr(13) || chr(10), chr(10)), chr(10)) AS l FROM instrument WHERE full_text IS NOT NULL),
    k AS (SELECT *, array_to_string(list_transform(l, lambda x: CASE WHEN trim(x) = '' THEN 'B' WHEN regexp_matches(x, {quoted(N.FORWARDED)}) THEN 'F' WHEN regexp_matches(x, {quoted(N.ADDRESSEE)}) THEN 'A' ELSE 'O' END), '') AS k FROM l),
    c AS (SELECT *, length(regexp_extract(k, '(F[BFA]*A[BFA]*)$')) AS b FROM k)
    SELECT id, length(full_text) AS chars, length(CASE WHEN b > 0 AND len(l) > b THEN regexp_replace(array_to_string(l[1:len(l) - b], chr(10)), '\s+$', '') ELSE full_text END) AS kept FROM c""",
)
def instrument_bodies(spark, sf):
    """Instruments without the block of addressees at their end."""
    i = table(spark, sf, "instrument").where("full_text is not null")
    return i.select("id", F.length("full_text").alias("chars"), F.length(N.strip_distribution(F.col("full_text"))).alias("kept"))


@CORE.query("rising_ends")
def rising_ends(spark, sf):
    """Where the longest rising run of each statute's sections ends, in order of their first capture."""
    v = table(spark, sf, "statute_section_version").select("statute_id", section_integer(F.col("section_number")).alias("n"), "created_at").where("n is not null")
    first = v.groupBy("statute_id", "n").agg(F.min("created_at").alias("at"))
    g = first.groupBy("statute_id").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("o"))
    return g.select("statute_id", N.rising_end(F.transform("o", lambda x: x["n"])).alias("rising_end"), F.size("o").alias("sections"))


_TOK = "list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w NOT IN ('', 'the', 'of', 'and', 'for', 'to', 'in', 'an', 'a', 'act', 'ordinance', 'order', 'rules', 'regulations', 'code') AND NOT regexp_matches(w, '^(18|19|20)[0-9]{{2}}$'))))"
_YR = "TRY_CAST(regexp_extract({0}, '((?:18|19|20)[0-9]{{2}})', 1) AS INTEGER)"


@CORE.query(
    "affected_titles",
    f"""WITH p AS (SELECT i.id, i.affected_statute_name AS a, s.name AS b, {_TOK.format('i.affected_statute_name')} AS x, {_TOK.format('s.name')} AS y, {_YR.format('i.affected_statute_name')} AS ya, {_YR.format('s.name')} AS yb FROM instrument i JOIN statute s ON s.id = i.affected_statute_id),
    m AS (SELECT *, len(list_intersect(x, y)) AS n, len(list_distinct(x || y)) AS u FROM p WHERE a IS NOT NULL),
    r AS (SELECT *, (n = least(len(x), len(y)) AND n >= 2) OR n / greatest(u, 1) >= 0.75 AS alike FROM m)
    SELECT id, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 'unknown' WHEN alike AND (ya IS NULL OR yb IS NULL OR ya = yb) THEN 'same' WHEN alike THEN 'year_differs' ELSE 'different' END AS relation FROM r""",
)
def affected_titles(spark, sf):
    """Whether the name an instrument gives its statute is that of the statute it is linked to."""
    s = table(spark, sf, "statute").select(F.col("id").alias("affected_statute_id"), "name")
    i = table(spark, sf, "instrument").where("affected_statute_name is not null").select("id", "affected_statute_id", "affected_statute_name")
    return i.join(s, "affected_statute_id").select("id", N.title_relation(F.col("affected_statute_name"), F.col("name")).alias("relation"))


_BARE = "regexp_replace(regexp_replace(trim(x), '(?i)^((mr|mrs|ms|dr|hon''?ble|justice)\\.?\\s+)+', '', 'g'), '(?i)^[ .]+|,?\\s*\\b(jj?|c\\.?j)\\.?$|[ .]+$', '', 'g')"


@CORE.query(
    "coram_benches",
    rf"""WITH c AS (SELECT id, judge_names, regexp_extract(coalesce(full_text, ''), {quoted(N.CORAM)}, 2) AS line FROM judgment WHERE full_text IS NOT NULL),
    n AS (SELECT id, judge_names, list_sort(list_distinct(list_filter(list_transform(string_split_regex(line, '\s*(?:,|;|\band\b|&)\s*'), lambda x: {_BARE}), lambda x: length(x) > 3 AND NOT regexp_matches(x, '[0-9]')))) AS coram FROM c)
    SELECT id, coram, coalesce(len(judge_names), 0) AS recorded FROM n WHERE len(coram) > 0""",
)
def coram_benches(spark, sf):
    """Judges named in the coram line of a text, wherever it stands, beside those on record."""
    j = table(spark, sf, "judgment").where("full_text is not null").select("id", F.array_sort(N.bench(F.col("full_text"))).alias("coram"), F.size(F.coalesce("judge_names", F.array().cast("array<string>"))).alias("recorded"))
    return j.where(F.size("coram") > 0)


@CORE.query(
    "sampled_section_chain",
    "SELECT v.id, s.name, i.title, md5(v.id || '|5') AS draw FROM statute_section_version v JOIN statute s ON s.id = v.statute_id LEFT JOIN instrument i ON i.id = lower(trim(v.amending_instrument_id)) WHERE length(v.section_text) > 40 ORDER BY draw, v.id LIMIT 40",
)
def sampled_section_chain(spark, sf):
    """A seeded sample of sections with statute and instrument; the sample is drawn before the joins."""
    v = table(spark, sf, "statute_section_version").where(F.length("section_text") > 40)
    v = v.join(table(spark, sf, "statute").select(F.col("id").alias("statute_id"), "name"), "statute_id").select("id", "name", F.lower(F.trim("amending_instrument_id")).alias("iid"), F.md5(F.concat("id", F.lit("|5"))).alias("draw"))
    few = v.orderBy("draw", "id").limit(40)
    return few.join(table(spark, sf, "instrument").select(F.col("id").alias("iid"), "title"), "iid", "left").select("id", "name", "title", "draw")


@CORE.query(
    "round_robin_offset",
    "WITH r AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos, count(*) OVER () AS n FROM instrument) SELECT id FROM r WHERE (pos - 100 % n + n) % n < 50",
)
def round_robin_offset(spark, sf):
    """The next fifty after an offset, wrapping around, in id order: two bounded reads of the ordered ids in place of a global rank."""
    i = table(spark, sf, "instrument").select("id")
    n = i.count()
    start = 100 % n if n else 0
    ordered = i.orderBy("id")
    take = min(50, n)
    first = ordered.offset(start).limit(take)
    wrapped = take - min(take, n - start)
    return first.unionByName(i.orderBy("id").limit(wrapped)) if wrapped else first


@CORE.query("section_maps", "SELECT statute_id, list_sort(list(DISTINCT section_number)) AS numbers, count(*) AS captures FROM statute_section_version WHERE statute_id IN (SELECT id FROM statute WHERE is_repealed) GROUP BY 1")
def section_maps(spark, sf):
    """Section numbers of repealed statutes."""
    gone = table(spark, sf, "statute").where("is_repealed").select(F.col("id").alias("statute_id"))
    return table(spark, sf, "statute_section_version").join(gone, "statute_id", "left_semi").groupBy("statute_id").agg(F.array_sort(F.collect_set("section_number")).alias("numbers"), F.count(F.lit(1)).alias("captures"))
