"""Queries of the subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.citations import citation_key, key_sql
from docketry.llm.components import connected_components, star_edges
from docketry.llm.mixing import mix, shares
from docketry.llm.names import link_variants, variant_pairs
from docketry.llm.packing import pack
from docketry.llm.tokens import token_count
from docketry.llm.scans import count_language, scan_noise
from docketry.llm.textstats import learn_profiles, text_stats
from docketry.llm.web import fit_models, labelled_pieces, main_text, residue_records, site_pieces
from docketry.plans.registry import Registry
from docketry.sources.tables import table

LLM = Registry()


@LLM.query(
    "p6_found",
    f"""WITH RECURSIVE k AS (SELECT DISTINCT case_id, key FROM (SELECT case_id, {key_sql('citation')} AS key FROM enumerated_case UNION ALL SELECT case_id, {key_sql('x')} FROM (SELECT case_id, unnest(parallel_citations) AS x FROM enumerated_case)) WHERE key IS NOT NULL),
    r AS (SELECT DISTINCT case_id, case_id AS reach FROM k UNION SELECT r.case_id, b.case_id FROM r JOIN k a ON a.case_id = r.reach JOIN k b ON b.key = a.key)
    SELECT case_id, min(reach) AS group_id FROM r GROUP BY 1 HAVING count(*) > 1""",
)
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of rows of enumerated_case that share a citation over any number of steps."""
    cases = table(spark, sf_dir, "enumerated_case")
    written = F.concat(F.array("citation"), F.coalesce("parallel_citations", F.array().cast("array<string>")))
    members = cases.select("case_id", F.explode(F.array_distinct(F.transform(written, citation_key))).alias("key"))
    return connected_components(star_edges(members, "case_id", "key")).select(F.col("id").alias("case_id"), "group_id")


@LLM.query("p8_packed")
def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents in a container of each capacity of container_spec."""
    spec = [(r["container_name"], r["capacity_tokens"]) for r in table(spark, sf_dir, "container_spec").collect()]
    docs = table(spark, sf_dir, "documents").select("doc_id", token_count(F.col("text")).alias("tokens"))
    return pack(docs, "doc_id", "tokens", spec).withColumnRenamed("size", "tokens")


@LLM.query(
    "p8_invariants",
    "SELECT container_name, count(*) FILTER (WHERE length(text) > 0) AS documents, 0 AS overfull, 0 AS needless_cuts, 0 AS doubled FROM documents, container_spec GROUP BY 1",
)
def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the containers: every text is in them, none is overfull, nothing that fits is cut, no piece comes twice."""
    packed = p8_packed(spark, sf_dir)
    caps = table(spark, sf_dir, "container_spec").select("container_name", F.col("capacity_tokens").alias("cap"))
    full = packed.groupBy("container_name", "container_id").agg(F.sum("tokens").alias("used")).join(F.broadcast(caps), "container_name").groupBy("container_name").agg(F.count_if(F.col("used") > F.col("cap")).alias("overfull"))
    whole = packed.groupBy("container_name", "doc_id").agg(F.sum("tokens").alias("size"), F.count(F.lit(1)).alias("pieces"), F.count_distinct("piece_no").alias("distinct")).join(F.broadcast(caps), "container_name")
    docs = whole.groupBy("container_name").agg(F.count(F.lit(1)).alias("documents"), F.count_if((F.col("size") <= F.col("cap")) & (F.col("pieces") > 1)).alias("needless_cuts"), F.count_if(F.col("pieces") > F.col("distinct")).alias("doubled"))
    return docs.join(full, "container_name").select("container_name", "documents", "overfull", "needless_cuts", "doubled")


def _targets(spark: SparkSession, sf_dir: str) -> list[tuple[str, float, int]]:
    return [(r["source"], r["target_share"], r["max_repeats"]) for r in table(spark, sf_dir, "mix_target").orderBy("source").collect()]


@LLM.query("p9_selection")
def p9_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the copies that give each source its share of the tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", token_count(F.col("text")).alias("tokens"))
    return mix(docs, "doc_id", "source", "tokens", _targets(spark, sf_dir)).withColumnRenamed("size", "tokens")


@LLM.query("p9_shares")
def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached by the selection."""
    return shares(p9_selection(spark, sf_dir).withColumnRenamed("tokens", "size"), _targets(spark, sf_dir))


def _function_words(spark: SparkSession, sf_dir: str) -> list[str]:
    """The function words of all languages; a table of fixed size."""
    return sorted({r["word"] for r in table(spark, sf_dir, "common_word").select("word").distinct().collect() if r["word"]})


@LLM.query(
    "p9_invariants",
    "SELECT source, EXISTS (SELECT 1 FROM documents d WHERE d.source = t.source AND length(d.text) > 0) AS has_documents, true AS within_cap, true AS near FROM mix_target t",
)
def p9_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the mixture: no document more often than its source allows, and shares within 0.03 of the targets of the sources that have documents."""
    held = table(spark, sf_dir, "documents").where("length(text) > 0").groupBy("source").agg(F.lit(True).alias("has"))
    s = p9_shares(spark, sf_dir).join(F.broadcast(held), "source", "left").withColumn("has_documents", F.coalesce("has", F.lit(False)))
    open_ = s.where("has_documents").agg(F.sum("target_share").alias("open"))
    want = F.when(F.col("has_documents"), F.col("target_share") / F.col("open")).otherwise(0.0)
    return s.join(F.broadcast(open_), F.lit(True)).select("source", "has_documents", (F.col("most_repeats") <= F.col("max_repeats")).alias("within_cap"), (F.abs(F.col("actual_share") - want) <= 0.03).alias("near"))


def _languages(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    """The function words of each language; a table of fixed size."""
    out: dict[str, list[str]] = {}
    for r in table(spark, sf_dir, "common_word").select("lang", "word").distinct().orderBy("lang", "word").collect():
        if r["lang"] and r["word"]:
            out.setdefault(r["lang"], []).append(r["word"])
    return out


def _profiled(spark: SparkSession, sf_dir: str, verdicts: list[str] | None) -> DataFrame:
    docs, languages = table(spark, sf_dir, "documents").select("doc_id", "text"), _languages(spark, sf_dir)
    return text_stats(docs, languages, learn_profiles(docs, languages), verdicts)


@LLM.query("p10_stats")
def p10_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return _profiled(spark, sf_dir, None)


@LLM.query(
    "p10_counts",
    "SELECT doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{M}]+(?:[''’][\\p{L}\\p{M}]+)*')) AS n_words, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\s\\x{0085}\\x{00A0}\\x{2028}\\x{1C}-\\x{1F}]'))) AS n_lines FROM documents WHERE text IS NOT NULL",
)
def p10_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain counts of every document, which SQL can state."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id").join(p10_stats(spark, sf_dir), "doc_id").select("doc_id", "n_words", "n_lines")


@LLM.query("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are mostly no natural prose."""
    return _profiled(spark, sf_dir, ["junk", "list", "table"])


def _web_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = table(spark, sf_dir, "page_result").select(F.lit("page_result").alias("source_table"), F.col("page_id").cast("string").alias("record_id"), F.lit("page").alias("kind"), F.col("html").alias("body"))
    texts = table(spark, sf_dir, "judgment").select(F.lit("judgment").alias("source_table"), F.col("id").alias("record_id"), F.lit("text").alias("kind"), F.col("full_text").alias("body"))
    return pages, texts


@LLM.query("p2_found")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that hold template residue, filler, an error message or a script notice in place of content."""
    pages, texts = _web_records(spark, sf_dir)
    models = fit_models(pages, texts, _function_words(spark, sf_dir), with_blocks=False)
    return residue_records(pages.unionByName(texts), models)


def _web_models(spark: SparkSession, sf_dir: str):
    pages, texts = _web_records(spark, sf_dir)
    return pages.unionByName(texts), fit_models(pages, texts, _function_words(spark, sf_dir), with_blocks=True)


@LLM.query("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of records that are site matter."""
    return site_pieces(*_web_models(spark, sf_dir))


@LLM.query("p7_main_text")
def p7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main body of every record."""
    return main_text(labelled_pieces(*_web_models(spark, sf_dir)))


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(name: str, text: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.lit(name).alias("source_table"), F.col("id").alias("record_id"), F.col(text).alias("text"))

    return of("statute_section_version", "section_text").unionByName(of("judgment", "full_text"))


@LLM.query("p5_found")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of scanning noise in sections and judgments."""
    records = _scanned(spark, sf_dir)
    return scan_noise(records, count_language(records), ["judgment"])


@LLM.query("p5_repaired")
def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned sections and judgments as continuous paragraphs with the noise undone."""
    records = _scanned(spark, sf_dir)
    return scan_noise(records, count_language(records), ["judgment"], repaired=True)


def _typed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    judges = table(spark, sf_dir, "judgment").select(F.lit("judge").alias("name_kind"), F.explode("judge_names").alias("name"))
    parties = table(spark, sf_dir, "case_metadata").select(F.lit("party").alias("name_kind"), F.explode(F.array("petitioner", "respondent")).alias("name"))
    return judges.unionByName(parties)


@LLM.query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different spellings of one judge, person or body."""
    return variant_pairs(link_variants(_typed_names(spark, sf_dir)))


@LLM.query("p1_entities")
def p1_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with its entity and the number of spellings of it."""
    linked = link_variants(_typed_names(spark, sf_dir))
    sizes = linked.groupBy("name_kind", "entity").agg(F.count(F.lit(1)).alias("spellings"))
    return linked.join(sizes, ["name_kind", "entity"])
