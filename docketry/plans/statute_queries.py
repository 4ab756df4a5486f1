"""Names, numbers, mentions and sections of statutes and instruments."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docketry.functions import lines as N
from docketry.functions import statutes as S
from docketry.functions.legal import section_integer
from docketry.functions.text import is_garbled
from docketry.plans.registry import CORE, quoted
from docketry.sources.tables import table

_FOLD = "trim(regexp_replace(replace(coalesce({0}, ''), chr(160), ' '), '\\s+', ' ', 'g'))"


def _key_sql(c: str) -> str:
    low = f"regexp_replace(regexp_replace(lower(trim(coalesce({c}, ''))), '[.,()]', '', 'g'), '\\s+', ' ', 'g')"
    return f"regexp_replace(regexp_replace({low}, '^(in|under|of|to) the ', ''), '^the ', '')"


def _roman_sql(token: str) -> str:
    worth = " ".join(f"WHEN '{k}' THEN {v}" for k, v in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)))
    at = lambda i: f"(CASE substr(upper({token}), {i}, 1) {worth} ELSE 0 END)"
    return f"CASE WHEN regexp_matches({token}, '^[0-9]+$') THEN TRY_CAST({token} AS INTEGER) ELSE nullif(CAST(list_sum(list_transform(generate_series(1, length({token})), lambda i: CASE WHEN {at('i')} < {at('i + 1')} THEN -{at('i')} ELSE {at('i')} END)) AS INTEGER), 0) END"


@CORE.query(
    "section_flags",
    rf"""SELECT id, regexp_matches(trim(section_number), {quoted(S.ZERO_SECTION)}) AND NOT regexp_matches(trim(section_number), {quoted(S.TARIFF_CHAPTER)}) AS zero, regexp_matches(trim(section_number), {quoted(S.YEAR_SECTION)}) AS year,
      coalesce(regexp_matches(section_text, {quoted(S.DATE_HEAD)}), false) AS dated, coalesce(TRY_CAST(nullif(regexp_extract(section_number, '([0-9]{{1,9}})', 1), '') AS INTEGER) > 5000, false) AS bogus, regexp_replace(upper(trim(section_number)), '[\s.]+', '', 'g') AS token FROM statute_section_version""",
)
def section_flags(spark, sf):
    """What is wrong with the numbers of sections: zero, a year, a date at the head of the text, beyond any act."""
    from docketry.functions.legal import is_year_section, section_token

    n, t = F.col("section_number"), F.col("section_text")
    return table(spark, sf, "statute_section_version").select("id", S.is_zero_section(n).alias("zero"), is_year_section(n).alias("year"), S.starts_with_date(t).alias("dated"), S.is_bogus_number(n).alias("bogus"), section_token(n).alias("token"))


@CORE.query(
    "statute_keys",
    f"SELECT id, {_key_sql('name')} AS key, regexp_replace({_key_sql('name')}, ' ?(19|20)[0-9]{{2}} ?$', '') AS yearless, {_key_sql('name')} = canonical_name_key AS as_stored FROM statute",
)
def statute_keys(spark, sf):
    """Keys by which names of statutes are compared, with and without their year."""
    k = S.statute_key(F.col("name"))
    return table(spark, sf, "statute").select("id", k.alias("key"), S.yearless(k).alias("yearless"), (k == F.col("canonical_name_key")).alias("as_stored"))


@CORE.query(
    "statute_name_canon",
    f"""WITH s AS (SELECT {_key_sql('name')} AS k, regexp_replace({_key_sql('name')}, ' ?(19|20)[0-9]{{2}} ?$', '') AS y, name FROM statute), a AS (SELECT k, min(name) AS name FROM s GROUP BY 1), b AS (SELECT y, min(name) AS name FROM s GROUP BY 1 HAVING count(*) = 1),
    i AS (SELECT id, year(instrument_date) AS year, affected_statute_name AS n, {_key_sql('affected_statute_name')} AS k FROM instrument WHERE affected_statute_name IS NOT NULL),
    c AS (SELECT id, year, regexp_replace(regexp_replace(trim(n), '^[.,;]+|[.,;]+$', '', 'g'), '\\s+', ' ', 'g') AS bare, k FROM i)
    SELECT id, coalesce(a.name, b.name, CASE WHEN year IS NOT NULL AND NOT regexp_matches(bare, '\\b(18|19|20)[0-9]{{2}}\\b') THEN bare || ', ' || year ELSE bare END) AS canonical, a.name IS NOT NULL OR b.name IS NOT NULL AS known
    FROM c LEFT JOIN a ON a.k = c.k LEFT JOIN b ON b.y = regexp_replace(c.k, ' ?(19|20)[0-9]{{2}} ?$', '')""".replace("\\\\", "\\"),
)
def statute_name_canon(spark, sf):
    """The canonical name of the statute that each instrument names: by the key, else by the key without the year if only one statute has it, else the name cleaned up."""
    s = table(spark, sf, "statute").select(S.statute_key(F.col("name")).alias("k"), "name").withColumn("y", S.yearless(F.col("k")))
    whole = s.groupBy("k").agg(F.min("name").alias("by_key"))
    part = s.groupBy("y").agg(F.min("name").alias("by_rest"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    i = table(spark, sf, "instrument").where("affected_statute_name is not null").select("id", F.year("instrument_date").alias("year"), F.col("affected_statute_name").alias("name"), S.statute_key(F.col("affected_statute_name")).alias("k")).withColumn("y", S.yearless(F.col("k")))
    j = i.join(whole, "k", "left").join(part, "y", "left")
    return j.select("id", F.coalesce("by_key", "by_rest", S.cleaned_name(F.col("name"), F.col("year"))).alias("canonical"), (F.col("by_key").isNotNull() | F.col("by_rest").isNotNull()).alias("known"))


@CORE.query(
    "name_faults",
    rf"""WITH n AS (SELECT id, title AS name FROM instrument UNION ALL SELECT id, name FROM statute UNION ALL SELECT work_id || '', json_extract_string(obj_json, '$.key') FROM judgment_upload_work), c AS (SELECT id, coalesce(name, '') AS r, {_FOLD.format('name')} AS n FROM n),
    f AS (SELECT id, n, regexp_matches(lower(n), '^means the |^further to amend|(^| )further to amend( |$)') AS clause, r = '' OR regexp_matches(r, 'JFIF|%PDF|\x00') OR len(regexp_extract_all(r, '[\p{{C}}\p{{Z}}]')) - (length(r) - length(replace(r, ' ', ''))) > 0.15 * length(r) AS garbage FROM c)
    SELECT id, clause, garbage, n <> '' AND (clause OR garbage OR regexp_matches(lower(n), {quoted(S.FILE_TOKENS)}) OR regexp_matches(regexp_replace(n, '\s', '', 'g'), '^[A-Za-z0-9+/=_-]{{20,}}$') OR regexp_matches(n, '%[0-9A-Fa-f]{{2}}') OR (length(n) - length(replace(n, '=', '')) >= 2 AND NOT contains(n, ' '))) AS fragment FROM f""",
)
def name_faults(spark, sf):
    """Titles, names and file names that are clauses, garbage or left-overs of a url."""
    names = table(spark, sf, "instrument").select("id", F.col("title").alias("name")).unionByName(table(spark, sf, "statute").select("id", "name")).unionByName(table(spark, sf, "judgment_upload_work").select(F.col("work_id").cast("string").alias("id"), F.get_json_object("obj_json", "$.key").alias("name")))
    n = F.col("name")
    return names.select("id", S.is_clause_fragment(n).alias("clause"), S.is_garbage_name(n).alias("garbage"), S.is_fragment_name(n).alias("fragment"))


@CORE.query(
    "act_numbers",
    f"""WITH t AS (SELECT id, 'The Gazette. ACT No. ' || (['IV', 'XIX', '12', 'IIX', 'CMX'])[1 + ord(id) % 5] || ' of ' || year(instrument_date) || ' ' || full_text AS t FROM instrument), m AS (SELECT id, regexp_extract(t, {quoted(S.ACT_NUMBER)}, 1) AS tok, TRY_CAST(regexp_extract(t, {quoted(S.ACT_NUMBER)}, 2) AS INTEGER) AS year FROM t)
    SELECT id, {_roman_sql('tok')} AS number, year FROM m WHERE tok <> '' AND ({_roman_sql('tok')}) IS NOT NULL""",
)
def act_numbers(spark, sf):
    """The act number of texts that are headed by one, in Roman or Arabic figures."""
    tokens = F.array(*map(F.lit, ["IV", "XIX", "12", "IIX", "CMX"]))
    t = F.concat(F.lit("The Gazette. ACT No. "), F.get(tokens, F.ascii("id") % 5), F.lit(" of "), F.year("instrument_date").cast("string"), F.lit(" "), F.col("full_text"))
    return table(spark, sf, "instrument").select("id", S.act_number(t).alias("a")).where("a is not null").select("id", "a.number", "a.year")


@CORE.query("numerals", f"SELECT DISTINCT l_quantity::INTEGER AS n, {_roman_sql('tok')} AS number FROM (SELECT l_quantity, repeat('X', l_quantity::INTEGER // 10) || (['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'])[1 + l_quantity::INTEGER % 10] AS tok FROM lineitem) WHERE tok <> ''")
def numerals(spark, sf):
    """Roman numerals of all quantities, read back."""
    q = F.col("l_quantity").cast("int")
    units = F.array(*map(F.lit, ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]))
    return table(spark, sf, "lineitem").select(q.alias("n")).distinct().select("n", F.concat(F.repeat(F.lit("X"), F.floor(F.col("n") / 10).cast("int")), F.get(units, F.col("n") % 10)).alias("t")).where("t <> ''").select("n", N.numeral(F.col("t")).alias("number"))


@CORE.query(
    "instrument_mention_forms",
    rf"""SELECT id, CASE WHEN regexp_matches(instrument_number, {quoted(S.MENTIONS['SRO'][0])}) THEN 'S.R.O. ' || upper(regexp_replace(regexp_extract(instrument_number, {quoted(S.MENTIONS['SRO'][0])}, 1), '\s+', '', 'g')) || '/' || regexp_extract(instrument_number, {quoted(S.MENTIONS['SRO'][0])}, 2)
      ELSE {_FOLD.format('instrument_number')} END AS sro, CASE WHEN regexp_matches(full_text, {quoted(S.MENTIONS['SRO'][0])}) THEN 'S.R.O. ' || upper(regexp_replace(regexp_extract(full_text, {quoted(S.MENTIONS['SRO'][0])}, 1), '\s+', '', 'g')) || '/' || regexp_extract(full_text, {quoted(S.MENTIONS['SRO'][0])}, 2) END AS said FROM instrument""",
)
def instrument_mention_forms(spark, sf):
    """The number of each instrument in its one form beside the number that its text gives."""
    t = F.col("full_text")
    return table(spark, sf, "instrument").select("id", S.instrument_mention(F.col("instrument_number"), "SRO").alias("sro"), F.when(t.rlike(S.MENTIONS["SRO"][0]), S.instrument_mention(t, "SRO")).alias("said"))


@CORE.query(
    "resolved_instruments",
    f"""WITH t AS (SELECT id, lower(id) AS k FROM instrument UNION ALL SELECT id, {_FOLD.format('instrument_number')} FROM instrument WHERE instrument_number IS NOT NULL), h AS (SELECT k, min(id) AS low, max(id) AS high FROM t GROUP BY 1),
    r AS (SELECT id, lower(trim(amending_instrument_id)) AS k FROM statute_section_version WHERE amending_instrument_id IS NOT NULL UNION ALL SELECT id, {_FOLD.format('instrument_number')} FROM instrument WHERE instrument_number IS NOT NULL)
    SELECT r.id, r.k AS target, CASE WHEN low = high THEN low END AS resolved_id, CASE WHEN low IS NULL THEN 'unresolved' WHEN low = high THEN 'linked' ELSE 'ambiguous' END AS resolution FROM r LEFT JOIN h USING (k)""",
)
def resolved_instruments(spark, sf):
    """References to instruments by id or by number, each tied to the one instrument it can mean: one set-based join in place of a scan per reference."""
    from docketry.functions.text import collapse
    from docketry.operators.identity import resolve_unique

    i = table(spark, sf, "instrument").select("id", F.lower("id").alias("by_id"), collapse(F.col("instrument_number")).alias("by_number"))
    refs = table(spark, sf, "statute_section_version").where("amending_instrument_id is not null").select("id", F.lower(F.trim("amending_instrument_id")).alias("target"))
    refs = refs.unionByName(i.where("by_number is not null").select("id", F.col("by_number").alias("target")))
    return resolve_unique(refs, "target", i.select(F.col("id").alias("iid"), "by_id", "by_number"), ["by_id", "by_number"], "iid")


@CORE.query(
    "resolved_sections",
    r"""WITH s AS (SELECT DISTINCT statute_id, section_number, upper(regexp_replace(trim(section_number), '[^0-9A-Za-z]', '', 'g')) AS norm, section_id FROM statute_section_version), e AS (SELECT statute_id, section_number, min(section_id) AS id FROM s GROUP BY 1, 2),
    n AS (SELECT statute_id, norm, min(section_id) AS id FROM s GROUP BY 1, 2 HAVING count(DISTINCT section_id) = 1),
    r AS (SELECT DISTINCT i.id, i.affected_statute_id AS statute_id, unnest(regexp_extract_all(full_text, 'section ([0-9]+[A-Z]?)', 1)) AS ref FROM instrument i WHERE affected_statute_id IS NOT NULL)
    SELECT r.id, r.ref, coalesce(e.id, n.id) AS section_id FROM r LEFT JOIN e ON e.statute_id = r.statute_id AND e.section_number = r.ref LEFT JOIN n ON n.statute_id = r.statute_id AND n.norm = upper(regexp_replace(r.ref, '[^0-9A-Za-z]', '', 'g'))""",
)
def resolved_sections(spark, sf):
    """Sections that instruments refer to, tied by the exact number, else by the number without punctuation if that is one section."""
    norm = lambda c: F.upper(F.regexp_replace(F.trim(c), "[^0-9A-Za-z]", ""))
    v = table(spark, sf, "statute_section_version").select("statute_id", "section_number", "section_id").distinct()
    exact = v.groupBy("statute_id", F.col("section_number").alias("ref")).agg(F.min("section_id").alias("by_number"))
    loose = v.groupBy("statute_id", norm("section_number").alias("norm")).agg(F.min("section_id").alias("by_norm"), F.count_distinct("section_id").alias("n")).where("n = 1").drop("n")
    r = table(spark, sf, "instrument").where("affected_statute_id is not null").select("id", F.col("affected_statute_id").alias("statute_id"), F.explode(F.array_distinct(F.regexp_extract_all("full_text", F.lit("section ([0-9]+[A-Z]?)"), F.lit(1)))).alias("ref"))
    j = r.join(exact, ["statute_id", "ref"], "left").withColumn("norm", norm("ref")).join(loose, ["statute_id", "norm"], "left")
    return j.select("id", "ref", F.coalesce("by_number", "by_norm").alias("section_id"))


_HEAD1 = "This enactment may be called the ' || name || '. It extends to the whole of the province."


@CORE.query(
    "called_titles",
    f"""WITH t AS (SELECT s.id, s.name, CASE WHEN ord(s.id) % 3 = 0 THEN 'It may be called the Grain Markets Act, 1911. ' ELSE '' END || CASE WHEN ord(s.id) % 5 < 4 THEN '{_HEAD1}' ELSE 'Preamble.' END AS t FROM statute s),
    c AS (SELECT id, name, regexp_extract_all(t, {quoted(S.CALLED)}, 1) AS called FROM t)
    SELECT id, called, len(called) > 0 AND NOT list_contains(list_transform(called, lambda x: {_key_sql('x')}), {_key_sql('name')}) AS mismatch FROM c""",
)
def called_titles(spark, sf):
    """The titles that first sections call their statutes by, and whether none of them is the stored name; a section without a title is no mismatch."""
    h = F.ascii("id")
    t = F.concat(F.when(h % 3 == 0, "It may be called the Grain Markets Act, 1911. ").otherwise(""), F.when(h % 5 < 4, F.concat(F.lit("This enactment may be called the "), "name", F.lit(". It extends to the whole of the province."))).otherwise("Preamble."))
    c = table(spark, sf, "statute").select("id", "name", S.called_titles(t).alias("called"))
    same = F.exists("called", lambda x: S.statute_key(x) == S.statute_key(F.col("name")))
    return c.select("id", "called", ((F.size("called") > 0) & ~same).alias("mismatch"))


@CORE.query(
    "act_segments",
    rf"""WITH l AS (SELECT id, array_to_string(list_transform(string_split(full_text, chr(10)), lambda x: CASE WHEN regexp_matches(trim(x), {quoted(S.SEGMENT_HEAD)}) THEN chr(1) || x ELSE x END), chr(10)) AS m FROM (SELECT id, full_text FROM instrument WHERE full_text IS NOT NULL UNION ALL SELECT doc_id || '', text FROM documents WHERE text IS NOT NULL)),
    p AS (SELECT id, unnest(list_filter(string_split(m, chr(1)), lambda x: trim(x) <> '')) AS body FROM l)
    SELECT id, CASE WHEN regexp_matches(trim(split_part(body, chr(10), 1)), {quoted(S.SEGMENT_HEAD)}) THEN trim(split_part(body, chr(10), 1)) ELSE '' END AS head, count(*) AS n, sum(length(body))::BIGINT AS chars FROM p GROUP BY 1, 2""",
)
def act_segments(spark, sf):
    """Gazettes and documents cut into the acts that they hold."""
    texts = table(spark, sf, "instrument").where("full_text is not null").select("id", F.col("full_text").alias("t")).unionByName(table(spark, sf, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("t")))
    return texts.select("id", F.explode(S.segments(F.col("t"))).alias("s")).groupBy("id", "s.head").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("s.body")).alias("chars"))


@CORE.query(
    "isolated_acts",
    rf"""WITH l AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN regexp_matches(trim(x), {quoted(S.SEGMENT_HEAD)}) THEN chr(1) || x ELSE x END), chr(10)) AS m FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, unnest(list_filter(string_split(m, chr(1)), lambda x: trim(x) <> '')) AS body FROM l), h AS (SELECT doc_id, trim(split_part(body, chr(10), 1)) AS head, body FROM p)
    SELECT doc_id, CASE WHEN count(*) = 1 THEN max(length(body)) END AS chars, CASE WHEN count(*) = 1 THEN 'resolved' ELSE 'unresolved' END AS outcome FROM h WHERE head = 'NOTIFICATION' GROUP BY 1""",
)
def isolated_acts(spark, sf):
    """The one segment of a bundle that has the wanted head; several with it stay unresolved."""
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", F.explode(S.segments(F.col("text"))).alias("s")).where("s.head = 'NOTIFICATION'")
    g = d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("s.body")).alias("c"))
    return g.select("doc_id", F.when(F.col("n") == 1, F.col("c")).alias("chars"), F.when(F.col("n") == 1, "resolved").otherwise("unresolved").alias("outcome"))


@CORE.query("embedded_headings", f"SELECT doc_id, len(h) AS headings, list_sort(list_distinct(h)) AS numbers FROM (SELECT doc_id, regexp_extract_all(text, {quoted(S.EMBEDDED_HEAD)}, 1) AS h FROM documents) WHERE len(h) > 0")
def embedded_headings(spark, sf):
    """Headings that stand inside bodies."""
    d = table(spark, sf, "documents").select("doc_id", S.embedded_headings(F.col("text")).alias("h")).where(F.size("h") > 0)
    return d.select("doc_id", F.size("h").alias("headings"), F.array_sort(F.array_distinct("h")).alias("numbers"))


_LINES = """WITH x AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), y AS (SELECT doc_id, unnest(l) AS t, generate_subscripts(l, 1) - 1 AS line FROM x),
    n AS (SELECT doc_id, line, t, TRY_CAST(nullif(regexp_extract(t, '^([0-9]{1,4})[.)] ', 1), '') AS INTEGER) AS number FROM y), h AS (SELECT * FROM n WHERE number IS NOT NULL)"""


def _headed(spark, sf):
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return d.withColumn("number", F.nullif(F.regexp_extract("t", "^([0-9]{1,4})[.)] ", 1), F.lit("")).cast("int")).where("number is not null")


@CORE.query("rising_runs", _LINES + ", r AS (SELECT *, sum(CASE WHEN number > was THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line) AS run FROM (SELECT *, lag(number, 1, 0) OVER (PARTITION BY doc_id ORDER BY line) AS was FROM h)) SELECT doc_id, CAST(run AS BIGINT) AS run, count(*) AS numbers, min(number) AS first, max(number) AS last FROM r GROUP BY 1, 2")
def rising_runs(spark, sf):
    """Strictly rising runs of the numbered lines of each document, in order. The lines of a document come from one row."""
    w = Window.partitionBy("doc_id").orderBy("line")
    h = _headed(spark, sf).withColumn("new", F.when(F.col("number") > F.lag("number", 1, 0).over(w), 0).otherwise(1))
    return h.withColumn("run", F.sum("new").over(w)).groupBy("doc_id", "run").agg(F.count(F.lit(1)).alias("numbers"), F.min("number").alias("first"), F.max("number").alias("last"))


@CORE.query("monotonic_numbers", _LINES + " SELECT doc_id, bool_and(number = was + 1) AS from_one, count(*) AS numbers FROM (SELECT *, lag(number, 1, 0) OVER (PARTITION BY doc_id ORDER BY line) AS was FROM h) GROUP BY 1")
def monotonic_numbers(spark, sf):
    """Whether the numbered lines of a document count from 1 without a gap."""
    w = Window.partitionBy("doc_id").orderBy("line")
    return _headed(spark, sf).withColumn("ok", F.col("number") == F.lag("number", 1, 0).over(w) + 1).groupBy("doc_id").agg(F.bool_and("ok").alias("from_one"), F.count(F.lit(1)).alias("numbers"))


@CORE.query("restarted_numbers", _LINES + " SELECT doc_id, count(*) FILTER (WHERE number = 1 AND was > 1) AS restarts, count(*) FILTER (WHERE number = 1 AND was > 1) > 0 AS several_acts FROM (SELECT *, lag(number, 1, 0) OVER (PARTITION BY doc_id ORDER BY line) AS was FROM h) GROUP BY 1")
def restarted_numbers(spark, sf):
    """Documents whose numbers start again at 1, as where a second act begins."""
    w = Window.partitionBy("doc_id").orderBy("line")
    h = _headed(spark, sf).withColumn("again", (F.col("number") == 1) & (F.lag("number", 1, 0).over(w) > 1))
    return h.groupBy("doc_id").agg(F.count_if("again").alias("restarts"), (F.count_if("again") > 0).alias("several_acts"))


@CORE.query(
    "body_over_contents",
    _LINES + """, b AS (SELECT *, regexp_matches(t, '[.]{4,}|[.] [.] [.]') AS listed FROM h), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, number ORDER BY listed, length(t) DESC, line) AS rn FROM b) SELECT doc_id, number, line, listed FROM r WHERE rn = 1""",
)
def body_over_contents(spark, sf):
    """Of lines of one number a body beats an entry of a contents list, then the longer wins, then the first."""
    h = _headed(spark, sf).withColumn("listed", F.col("t").rlike(r"[.]{4,}|[.] [.] [.]"))
    best = F.max(F.struct((~F.col("listed")).alias("body"), F.length("t").alias("n"), (-F.col("line")).alias("l")))
    return h.groupBy("doc_id", "number").agg(best.alias("b")).select("doc_id", "number", (-F.col("b.l")).alias("line"), (~F.col("b.body")).alias("listed"))


_ZERO = f"{{0}}, CASE WHEN regexp_matches(t, '^0\\s*\\)') THEN 'A' WHEN regexp_matches(t, '^0\\s*\\.\\s*[0-9]') THEN 'B' WHEN regexp_matches(t, '^0\\s*\\.') THEN 'C' ELSE 'unknown' END AS class"


@CORE.query(
    "zero_section_plan",
    rf"""WITH v AS (SELECT statute_id, row_number() OVER (PARTITION BY statute_id ORDER BY created_at, id) AS pos, section_number AS num, trim(coalesce(section_text, '')) AS body FROM statute_section_version WHERE length(section_text) < 400),
    z AS (SELECT *, pos % 4 = 0 AS zero, CASE WHEN pos % 8 = 0 THEN '0) ' WHEN pos % 12 = 0 THEN '0.5 ' WHEN pos % 4 = 0 THEN '0. ' ELSE '' END || body AS t FROM v),
    k AS (SELECT {_ZERO.format('*')}, max(CASE WHEN NOT zero THEN pos END) OVER (PARTITION BY statute_id ORDER BY pos) AS target FROM z)
    SELECT statute_id, pos, class, target, md5(t) AS md5 FROM k WHERE zero AND target IS NOT NULL AND body <> ''""",
)
def zero_section_plan(spark, sf):
    """Sections numbered '0', here every fourth capture of a statute, with their class and the real section that each is to be appended to."""
    first = Window.partitionBy("statute_id").orderBy("created_at", "id")
    v = table(spark, sf, "statute_section_version").where("length(section_text) < 400").withColumn("pos", F.row_number().over(first)).withColumn("body", F.trim("section_text"))
    zero = F.col("pos") % 4 == 0
    t = F.concat(F.when(F.col("pos") % 8 == 0, "0) ").when(F.col("pos") % 12 == 0, "0.5 ").when(zero, "0. ").otherwise(""), "body")
    w = Window.partitionBy("statute_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    k = v.withColumn("t", t).withColumn("target", F.last(F.when(~zero, F.col("pos")), ignorenulls=True).over(w)).where(zero & F.col("target").isNotNull() & (F.col("body") != ""))
    return k.select("statute_id", "pos", S.zero_class(F.col("t")).alias("class"), "target", F.md5("t").alias("md5"))


@CORE.query(
    "merged_reextracts",
    """WITH a AS (SELECT statute_id, section_number, max_by(section_text, (created_at, id)) AS t FROM statute_section_version WHERE version_no = 1 GROUP BY 1, 2), b AS (SELECT statute_id, section_number, max_by(section_text, (created_at, id)) AS t FROM statute_section_version WHERE version_no > 1 GROUP BY 1, 2)
    SELECT coalesce(a.statute_id, b.statute_id) AS statute_id, coalesce(a.section_number, b.section_number) AS section_number, md5(coalesce(nullif(trim(b.t), ''), trim(a.t))) AS md5, coalesce(trim(b.t), '') <> '' AS later FROM a FULL JOIN b ON a.statute_id = b.statute_id AND a.section_number = b.section_number""",
)
def merged_reextracts(spark, sf):
    """Two extractions merged by number; the later text wins where it is not blank."""
    v = table(spark, sf, "statute_section_version")

    def last(rows, name):
        return rows.groupBy("statute_id", "section_number").agg(F.max_by("section_text", F.struct("created_at", "id")).alias(name))

    j = last(v.where("version_no = 1"), "a").join(last(v.where("version_no > 1"), "b"), ["statute_id", "section_number"], "full_outer")
    return j.select("statute_id", "section_number", F.md5(F.coalesce(F.nullif(F.trim("b"), F.lit("")), F.trim("a"))).alias("md5"), (F.coalesce(F.trim("b"), F.lit("")) != "").alias("later"))


@CORE.query(
    "trailing_schedules",
    rf"""WITH t AS (SELECT id, full_text || CASE WHEN ord(id) % 2 = 0 THEN chr(10) || 'THE FIRST SCHEDULE' || chr(10) || '1 2 3' ELSE '' END AS t FROM instrument WHERE full_text IS NOT NULL),
    p AS (SELECT id, t, strpos(t, nullif(regexp_extract(t, '(?s)\n\s*(?:THE )?(?:FIRST |SECOND |THIRD |FOURTH )?(?:SCHEDULE|ANNEXURE|APPENDIX|Schedule|Annexure|Appendix)\b[^\n]*\n.*\S'), '')) AS spot FROM t)
    SELECT id, length(CASE WHEN spot > 1 THEN rtrim(left(t, spot - 1)) ELSE t END) AS body, length(CASE WHEN spot > 1 THEN trim(regexp_replace(substr(t, spot), '^\s+', '')) END) AS schedule FROM p""",
)
def trailing_schedules(spark, sf):
    """Instruments, every other one given a schedule, cut before it."""
    t = F.concat("full_text", F.when(F.ascii("id") % 2 == 0, "\nTHE FIRST SCHEDULE\n1 2 3").otherwise(""))
    i = table(spark, sf, "instrument").where("full_text is not null").select("id", S.peel_schedule(t).alias("p"))
    return i.select("id", F.length("p.body").alias("body"), F.length("p.schedule").alias("schedule"))


@CORE.query(
    "section_strategies",
    r"""WITH d AS (SELECT doc_id, text, len(regexp_extract_all(chr(10) || text, '\nSection [0-9]+[A-Z]?\. ')) AS a, len(regexp_extract_all(chr(10) || text, '\n[0-9]+[A-Z]?\. ')) AS b, len(regexp_extract_all(chr(10) || text, '\n[0-9]+[A-Z]?\) ')) AS c FROM documents WHERE trim(coalesce(text, '')) <> '')
    SELECT doc_id, CASE WHEN a >= 2 THEN 'keyword' WHEN b >= 2 THEN 'point' WHEN c >= 2 THEN 'bracket' ELSE 'whole' END AS strategy, CASE WHEN a >= 2 THEN a WHEN b >= 2 THEN b WHEN c >= 2 THEN c ELSE 1 END AS sections FROM d""",
)
def section_strategies(spark, sf):
    """How each text is split into sections: the first of three ways that finds two headings, else as one."""
    t = F.concat(F.lit("\n"), F.col("text"))
    ways = [("keyword", r"\nSection [0-9]+[A-Z]?\. "), ("point", r"\n[0-9]+[A-Z]?\. "), ("bracket", r"\n[0-9]+[A-Z]?\) ")]
    name, n = F.lit("whole"), F.lit(1)
    for way, pattern in reversed(ways):
        found = F.regexp_count(t, F.lit(pattern))
        name, n = F.when(found >= 2, way).otherwise(name), F.when(found >= 2, found).otherwise(n)
    return table(spark, sf, "documents").where("trim(coalesce(text, '')) <> ''").select("doc_id", name.alias("strategy"), n.alias("sections"))


_SUBST = """WITH v AS (SELECT statute_id, section_number, TRY_CAST(nullif(regexp_extract(section_number, '^([0-9]{1,9})', 1), '') AS INTEGER) AS n, max(length(trim(coalesce(section_text, '')))) AS chars FROM statute_section_version GROUP BY 1, 2, 3)"""


@CORE.query("substantive_ends", _SUBST + " SELECT v.statute_id, s.jurisdiction, coalesce(max(n) FILTER (WHERE chars >= 40 AND n NOT BETWEEN 1800 AND 2100 AND n <= 5000), 0) AS run_end FROM v JOIN statute s ON s.id = v.statute_id GROUP BY 1, 2")
def substantive_ends(spark, sf):
    """The last section of each statute with a body of 40 characters."""
    v = table(spark, sf, "statute_section_version").select("statute_id", section_integer(F.col("section_number")).alias("n"), F.length(F.trim("section_text")).alias("chars"))
    sound = (F.col("chars") >= 40) & ~F.col("n").between(1800, 2100) & (F.col("n") <= 5000)
    g = v.groupBy("statute_id").agg(F.coalesce(F.max(F.when(sound, F.col("n"))), F.lit(0)).alias("run_end"))
    return g.join(table(spark, sf, "statute").select(F.col("id").alias("statute_id"), "jurisdiction"), "statute_id").select("statute_id", "jurisdiction", "run_end")


@CORE.query("group_ends", _SUBST + ", e AS (SELECT v.statute_id, s.jurisdiction, coalesce(max(n) FILTER (WHERE chars >= 40 AND n NOT BETWEEN 1800 AND 2100 AND n <= 5000), 0) AS run_end FROM v JOIN statute s ON s.id = v.statute_id GROUP BY 1, 2) SELECT jurisdiction, max(run_end) AS run_end, count(*) AS statutes FROM e GROUP BY 1")
def group_ends(spark, sf):
    """The greatest of these ends over each group of statutes."""
    return substantive_ends(spark, sf).groupBy("jurisdiction").agg(F.max("run_end").alias("run_end"), F.count(F.lit(1)).alias("statutes"))


_STATUTE_FACTS = rf"""WITH v AS (SELECT statute_id, count(DISTINCT section_number) AS sections, count(*) AS captures, count(*) FILTER (WHERE length(trim(coalesce(section_text, ''))) >= 40) AS bodies, count(*) FILTER (WHERE length(trim(coalesce(section_text, ''))) >= 80) AS long FROM statute_section_version GROUP BY 1)"""


@CORE.query(
    "statute_verdicts",
    _STATUTE_FACTS + r""", s AS (SELECT s.*, coalesce(sections, 0) AS sections, coalesce(bodies, 0) AS bodies, captures FROM statute s LEFT JOIN v ON v.statute_id = s.id)
    SELECT id, CASE WHEN trim(coalesce(name, '')) = '' THEN 'no_name' WHEN NOT regexp_matches(name, 'Act|Ordinance|Order|Rules|Regulations|Code') THEN 'not_legislation' WHEN sections = 0 THEN 'no_sections' WHEN bodies * 2 < captures THEN 'thin_sections' WHEN year_enacted IS NULL THEN 'no_year' WHEN canonical_name_key IS NULL THEN 'no_key' ELSE 'ok' END AS reason FROM s""",
)
def statute_verdicts(spark, sf):
    """The first rule that each statute breaks, ok where it breaks none."""
    v = table(spark, sf, "statute_section_version").groupBy("statute_id").agg(F.count_distinct("section_number").alias("sections"), F.count(F.lit(1)).alias("captures"), F.count_if(F.length(F.trim("section_text")) >= 40).alias("bodies"))
    s = table(spark, sf, "statute").join(v, F.col("id") == F.col("statute_id"), "left")
    n0 = lambda c: F.coalesce(F.col(c), F.lit(0))
    reason = (
        F.when(F.trim(F.coalesce("name", F.lit(""))) == "", "no_name").when(~F.col("name").rlike("Act|Ordinance|Order|Rules|Regulations|Code"), "not_legislation").when(n0("sections") == 0, "no_sections")
        .when(n0("bodies") * 2 < F.col("captures"), "thin_sections").when(F.col("year_enacted").isNull(), "no_year").when(F.col("canonical_name_key").isNull(), "no_key").otherwise("ok")
    )
    return s.select("id", reason.alias("reason"))


@CORE.query("statute_verdict_counts", f"SELECT reason, count(*) AS n FROM ({CORE.sql['statute_verdicts']}) GROUP BY 1")
def statute_verdict_counts(spark, sf):
    """Statutes by the first rule that they break."""
    return statute_verdicts(spark, sf).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@CORE.query("dated_sections_by_jurisdiction", f"SELECT s.jurisdiction, count(*) AS sections, count(*) FILTER (WHERE regexp_matches(v.section_text, {quoted(S.DATE_HEAD)})) AS dated, count(*) FILTER (WHERE regexp_matches(trim(v.section_number), {quoted(S.YEAR_SECTION)})) AS year_numbered FROM statute_section_version v JOIN statute s ON s.id = v.statute_id GROUP BY 1")
def dated_sections(spark, sf):
    """Sections headed by a date or numbered by a year per jurisdiction; counted per statute before the join."""
    v = table(spark, sf, "statute_section_version").groupBy("statute_id").agg(F.count(F.lit(1)).alias("a"), F.count_if(S.starts_with_date(F.col("section_text"))).alias("b"), F.count_if(F.trim("section_number").rlike(S.YEAR_SECTION)).alias("c"))
    j = v.join(table(spark, sf, "statute").select(F.col("id").alias("statute_id"), "jurisdiction"), "statute_id")
    return j.groupBy("jurisdiction").agg(F.sum("a").alias("sections"), F.sum("b").alias("dated"), F.sum("c").alias("year_numbered"))


@CORE.query("unreadable_statutes", _STATUTE_FACTS.replace("FROM statute_section_version GROUP BY 1)", """, count(*) FILTER (WHERE length(trim(coalesce(section_text, ''))) >= 80 AND 1 - (length(trim(section_text)) - length(regexp_replace(trim(section_text), '[A-Za-z]{4,}', '', 'g'))) / length(trim(section_text)) > 0.75) AS bad FROM statute_section_version GROUP BY 1)""") + " SELECT statute_id, long, bad AS garbled, bad > 0.5 * long AS unreadable FROM v")
def unreadable_statutes(spark, sf):
    """Statutes most of whose long sections are garbled."""
    t = F.col("section_text")
    v = table(spark, sf, "statute_section_version").select("statute_id", (F.length(F.trim(F.coalesce(t, F.lit("")))) >= 80).alias("long"), is_garbled(t).alias("bad"))
    return v.groupBy("statute_id").agg(F.count_if("long").alias("long"), F.count_if("bad").alias("garbled"), (F.count_if("bad") > 0.5 * F.count_if("long")).alias("unreadable"))


@CORE.query("jurisdiction_fixes", r"WITH m AS (SELECT *, split_part(name, ' ', 1) AS w FROM statute), k AS (SELECT DISTINCT jurisdiction FROM statute WHERE jurisdiction <> 'Federal') SELECT m.id, m.jurisdiction, k.jurisdiction AS proposed FROM m JOIN k ON k.jurisdiction = m.w WHERE m.jurisdiction IS DISTINCT FROM k.jurisdiction")
def jurisdiction_fixes(spark, sf):
    """Statutes whose name begins with another jurisdiction than the one on record."""
    s = table(spark, sf, "statute")
    known = s.where("jurisdiction <> 'Federal'").select(F.col("jurisdiction").alias("proposed")).distinct()
    return s.join(F.broadcast(known), F.split_part("name", F.lit(" "), F.lit(1)) == F.col("proposed")).where(~F.col("jurisdiction").eqNullSafe(F.col("proposed"))).select("id", "jurisdiction", "proposed")


