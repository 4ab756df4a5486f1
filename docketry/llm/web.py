"""Records taken from the web: which are residue, and which of their pieces are site matter.

The models of residue are fitted on every record: the executors label the records and count their n-grams, and only counts
of a fixed size reach the driver. The labeller of blocks is trained on a bounded sample, the records with the smallest
hashes of their ids. Both are broadcast; every record is then read in one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm import blocks, residue
from docketry.llm.pages import page_leaves, text_leaves
from docketry.llm.seeds import MAIN, RESIDUE, SITE, free_lines, label_lines, label_page, label_record, least_recurring, may_recur, recurs, relabelled
from docketry.session import checkpointed, shuffle_width

#: Records of each table that the block labeller is fitted on.
BLOCK_SAMPLE = 700
#: Records that are read at a time; among so many there are enough of like length to run together.
CHUNK = 768
LINE = ("line",)


@dataclass
class WebModels:
    residue: residue.ResidueModel
    blocks: blocks.BlockModel | None


def read_record(kind: str, body: str | None) -> tuple[list[str], list[tuple[str, ...]], list[int]]:
    """(leaves, their tag paths, their numbers) of a 'page' or 'text' record; a page without any other text has its noscript notice, as number 0."""
    return _read(kind, body)[:3]


def _read(kind: str, body: str | None) -> tuple[list[str], list[tuple[str, ...]], list[int], list[tuple[int, ...]]]:
    """What read_record gives, and the ids of the elements around each leaf of a page."""
    if kind == "text":
        lines = text_leaves(body)
        return [x for _, x in lines], [LINE] * len(lines), [i for i, _ in lines], []
    leaves, hidden = page_leaves(body)
    if not leaves:
        return ([hidden], [("noscript",)], [0], []) if hidden else ([], [], [], [])
    return [x for x, _, _ in leaves], [p for _, p, _ in leaves], list(range(1, len(leaves) + 1)), [a for _, _, a in leaves]


@dataclass
class _Example:
    leaves: list[str]
    paths: list[tuple[str, ...]]
    placed: list[int]
    known: list[int] | None


def _examples(records: DataFrame, n: int, common: frozenset[str]) -> list[_Example]:
    """The n records with the smallest hashes of their ids, read and labelled where they lie. A filter on the hash leaves little
    more than n rows before anything is labelled, sorted or sent, so that what reaches the driver does not grow with the table."""
    total = records.count()
    share = min(1.0, (1.25 * n + 50) / max(total, 1))
    h = F.xxhash64("record_id")
    picked = records.where((h <= F.lit(min(2**63 - 1, int(-(2**63) + share * (2**64 - 1))))) & (F.length("body") > 0)).select(h.alias("h"), "record_id", "kind", "body")

    def look(batches):
        for batch in batches:
            rows = []
            for h, record, kind, body in zip(batch["h"], batch["record_id"], batch["kind"], batch["body"]):
                leaves, paths, placed, known = _label(kind, body, common)
                rows.append((h, record, leaves, ["\n".join(p) for p in paths], placed, known))
            yield pd.DataFrame(rows, columns=["h", "record_id", "leaves", "paths", "placed", "known"], dtype=object)

    found = picked.repartition(shuffle_width(records.sparkSession)).mapInPandas(look, "h bigint, record_id string, leaves array<string>, paths array<string>, placed array<int>, known array<int>").orderBy("h", "record_id").limit(n)
    return [_Example(r["leaves"], [tuple(p.split("\n")) for p in r["paths"]], r["placed"], r["known"]) for r in found.drop("h", "record_id").collect()]


def _label(kind: str, body: str | None, common: frozenset[str]) -> tuple[list[str], list[tuple[str, ...]], list[int], list[int] | None]:
    """(leaves, their tag paths, their place as MAIN or SITE, their labels if the record is a clear example) of a record."""
    leaves, paths, numbers, around = _read(kind, body)
    if not leaves:
        return [], [], [], None
    placed = label_page(list(zip(leaves, paths, around)), common) if kind == "page" and numbers != [0] else label_lines(leaves, common)
    return leaves, paths, placed, label_record(leaves, placed, common)


def _labelled_records(records: DataFrame, common: frozenset[str]) -> DataFrame:
    """(text, known, lined, sited) of every record that has leaves: the leaves a line each, their labels a byte each or null where the
    record is no clear example; whether it is a text that is clearly no residue, and one that has site matter. Written once, since it is read in rounds."""

    def look(batches):
        for batch in batches:
            rows = []
            for kind, body in zip(batch["kind"], batch["body"]):
                leaves, _, _, known = _label(kind, body, common)
                if leaves:
                    lined = kind == "text" and known is not None and RESIDUE not in known
                    rows.append(("\n".join(leaves), None if known is None else bytes(known), lined, lined and SITE in known))
            yield pd.DataFrame(rows, columns=["text", "known", "lined", "sited"])

    return checkpointed(records.where(F.length("body") > 0).select("kind", "body").mapInPandas(look, "text string, known binary, lined boolean, sited boolean"))


def _frequent_lines(labelled: DataFrame) -> tuple[int, dict[str, tuple[int, int]]]:
    """(the least number of texts in which a line recurs, {line: texts with site matter that have it, all texts that have it} of the lines
    that recur). A share of the texts is asked, so that there can be no more of them than the lines of some hundreds of texts."""
    lined = labelled.where("lined")
    least = least_recurring(lined.count())
    lines = lined.select(F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"), "sited")
    found = lines.groupBy("line").agg(F.count_if("sited").alias("inside"), F.count(F.lit(1)).alias("whole")).where(F.col("whole") >= least)
    return least, {r["line"]: (r["inside"], r["whole"]) for r in found.collect()}


def _slots(counts: np.ndarray) -> pd.DataFrame:
    flat = counts.reshape(-1)
    at = np.flatnonzero(flat)
    return pd.DataFrame({"slot": at.astype(np.int32), "line": None, "n": flat[at], "free": 0})


def _gathered(parts: DataFrame) -> tuple[np.ndarray, dict[str, tuple[int, int]]]:
    """The counts by slot, which are of a fixed size, and of the lines that may recur, summed over the tasks."""
    got = parts.groupBy("slot", "line").agg(F.sum("n").alias("n"), F.sum("free").alias("free")).toArrow()
    slot, n = got["slot"].to_numpy(), got["n"].to_numpy()
    counts = np.zeros(residue.GramCounts().n.size, np.int64)
    counts[slot[slot >= 0]] = n[slot >= 0]
    lines = got.filter(pc.less(got["slot"], 0)).to_pylist()
    return counts.reshape(residue.GramCounts().n.shape), {r["line"]: (r["n"], r["free"]) for r in lines}


_PARTS = "slot int, line string, n bigint, free bigint"


def _residue_model(labelled: DataFrame) -> tuple[residue.ResidueModel, frozenset[str]]:
    """The n-gram models of all records, with one round of self-training, and the lines that sites put into their texts."""
    context = labelled.sparkSession.sparkContext
    least, seen = _frequent_lines(labelled)
    sought = frozenset(x for x, (inside, whole) in seen.items() if may_recur(x, inside, whole, least))
    shared = context.broadcast((frozenset(seen), sought))

    def count(batches):
        frequent, sought = shared.value
        grams, main, free = residue.GramCounts(), Counter(), Counter()
        for batch in batches:
            for text, known, lined in zip(batch["text"], batch["known"], batch["lined"]):
                leaves = text.split("\n")
                if lined and not sought.isdisjoint(leaves):  # these lines are counted by themselves until it is known what they are
                    for x in free_lines(leaves, known, sought, frequent):
                        free[x] += 1
                    aside = [y == MAIN and x in sought for x, y in zip(leaves, known)]
                    main.update(compress(leaves, aside))
                    rest = [not a for a in aside]
                    leaves, known = list(compress(leaves, rest)), list(compress(known, rest))
                grams.add(leaves, known)
        yield _slots(grams.total())
        yield pd.DataFrame([(-1, x, main[x], free[x]) for x in main | free], columns=["slot", "line", "n", "free"])

    counts, lines = _gathered(labelled.where("known is not null").select("text", "known", "lined").mapInPandas(count, _PARTS))
    site_lines = frozenset(x for x, (_, free) in lines.items() if recurs(free, seen[x][1]))
    for x, (n, _) in lines.items():
        one = residue.GramCounts()
        one.add([x], [SITE if x in site_lines else MAIN])
        counts += n * one.total()
    model = context.broadcast((residue.fit(counts), site_lines))

    def change(batches):
        first, site_lines = model.value
        more, less = residue.GramCounts(), residue.GramCounts()
        for batch in batches:
            records = [x.split("\n") for x in batch["text"]]
            labels = [relabelled(x, y, site_lines) if lined else y for x, y, lined in zip(records, batch["known"], batch["lined"])]
            for x, old, new in zip(records, labels, residue.second_labels(first, records, labels)):
                if new is not old:
                    more.add(x, new)
                    if old is not None:
                        less.add(x, old)
        yield _slots(more.total() - less.total())

    changes, _ = _gathered(labelled.select("text", "known", "lined").mapInPandas(change, _PARTS))
    return residue.fit(counts + changes), site_lines


def fit_models(pages: DataFrame, texts: DataFrame, function_words: list[str], with_blocks: bool) -> WebModels:
    """Models from the records (record_id, kind, body) of the two tables: those of residue from all of them, the block labeller from
    at most BLOCK_SAMPLE of each; empty tables give models that find nothing."""
    common = frozenset(w.lower() for w in function_words)
    model, site_lines = _residue_model(_labelled_records(pages.select("kind", "body").unionByName(texts.select("kind", "body")), common))
    if not with_blocks:
        return WebModels(model, None)
    rows = [x for records in (pages, texts) for x in _examples(records, BLOCK_SAMPLE, common)]
    clear = [x for x in rows if x.leaves and x.known is not None and RESIDUE not in x.known]
    docs = [[blocks.leaf_tokens(t, p) for t, p in zip(x.leaves, x.paths)] for x in clear]
    return WebModels(model, blocks.train(docs, [relabelled(x.leaves, x.placed, site_lines) if x.paths[0] == LINE else x.placed for x in clear]))


def residue_records(records: DataFrame, models: WebModels) -> DataFrame:
    """(source_table, record_id) of the records (source_table, record_id, kind, body) that are residue.

    Null, blank and text-free bodies are none; a record that holds its real content is none, whatever words occur in it.
    """
    shared = records.sparkSession.sparkContext.broadcast(models.residue)

    def read(batches):
        for batch in batches:
            leaves = [read_record(k, b)[0] for k, b in zip(batch["kind"], batch["body"])]
            hit = residue.is_residue_record(*residue.residue_coverage(shared.value, leaves))
            yield batch.loc[hit, ["source_table", "record_id"]]

    return records.where(F.length("body") > 0).select("source_table", "record_id", "kind", "body").mapInPandas(read, "source_table string, record_id string")


def site_pieces(records: DataFrame, models: WebModels) -> DataFrame:
    """(source_table, record_id, piece_no) of the pieces that are not main body, in the records that are no residue."""
    return _labelled(records, models, "source_table string, record_id string, piece_no int", lambda d: d.loc[d["site"].astype(bool), ["source_table", "record_id", "piece_no"]])


def labelled_pieces(records: DataFrame, models: WebModels) -> DataFrame:
    """(source_table, record_id, piece_no, text, site) of every piece of the records that are no residue; ``site`` marks what is not main body."""
    return _labelled(records, models, "source_table string, record_id string, piece_no int, text string, site boolean", lambda d: d)


def _labelled(records: DataFrame, models: WebModels, schema: str, keep) -> DataFrame:
    context = records.sparkSession.sparkContext
    shared = context.broadcast(models)

    def read(batches):
        vectors = blocks.LeafVectors(shared.value.blocks)
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                yield keep(_pieces(batch.iloc[at : at + CHUNK], shared.value, vectors))

    return records.where(F.length("body") > 0).select("source_table", "record_id", "kind", "body").mapInPandas(read, schema)


def _pieces(batch: pd.DataFrame, models: WebModels, vectors: blocks.LeafVectors) -> pd.DataFrame:
    read = [read_record(k, b) for k, b in zip(batch["kind"], batch["body"])]
    hit = residue.is_residue_record(*residue.residue_coverage(models.residue, [r[0] for r in read]))
    docs = [[] if h else list(zip(leaves, paths)) for h, (leaves, paths, _) in zip(hit, read)]
    out: dict[str, list] = {"source_table": [], "record_id": [], "piece_no": [], "text": [], "site": []}
    for table, record, (leaves, _, numbers), p in zip(batch["source_table"], batch["record_id"], read, blocks.probabilities(vectors, docs)):
        if not len(p) or numbers == [0]:
            continue
        out["source_table"] += [table] * len(p)
        out["record_id"] += [record] * len(p)
        out["piece_no"] += numbers
        out["text"] += leaves
        out["site"] += (p > 0.5).tolist()
    return pd.DataFrame(out)


def main_text(pieces: DataFrame) -> DataFrame:
    """(source_table, record_id, main_text): the main body of each record, its pieces in order, one to a line; '' where all is site matter.

    A record's pieces come from one row, so a group is never larger than one document.
    """
    kept = F.filter(F.array_sort(F.collect_list(F.struct("piece_no", "site", "text"))), lambda x: ~x["site"])
    return pieces.groupBy("source_table", "record_id").agg(F.array_join(F.transform(kept, lambda x: x["text"]), "\n").alias("main_text"))


__all__ = ["MAIN", "WebModels", "fit_models", "labelled_pieces", "main_text", "read_record", "residue_records", "site_pieces"]
