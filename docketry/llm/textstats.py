"""Per-document text statistics and the verdict prose, list, table or junk.

Four distributions describe a text: its tokens over the function words of each language and over word forms, its
characters over character classes, its lines over line forms, and its word triples over new and repeated ones. Profiles
of prose in each language, of lists, tables and kinds of junk are fitted to a bounded sample; the nearest profile by
Jensen-Shannon divergence is the verdict. All is computed for a batch of texts at a time.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.shapes import label
from docketry.session import shuffle_width

#: Documents that the profiles are fitted on: those with the smallest hashes of their ids.
SAMPLE = 4000
#: Profiles that a kind of text begins with and may grow to where the sample shows that it needs them.
PROFILES, MOST_PROFILES = 6, 24
#: What the divergence of each distribution counts for.
WEIGHTS = {"words": 1.0, "forms": 1.0, "chars": 1.0, "lines": 0.6, "repeats": 1.5}

CHARS = ["lower", "upper", "caseless", "latin1", "digit", "stop", "comma", "apostrophe", "dash", "bracket", "separator", "symbol", "query", "lost", "control", "blank", "newline"]
FORMS = ["lower", "capital", "upper", "caseless", "figure", "figured", "mark", "symbol", "foreign", "damaged", "endless", "leader"]
REPEATS = ["new", "repeated"]
_LOST, _ENDLESS = 0xFFFD, 30
_STOPS = ".!?:;۔؟"


def _line_forms() -> list[str]:
    sizes = ["1-3", "4-8", "9-16", "17-"]
    plain = [f"{mark}{size}{known}" for mark in ("", "numbered ", "marked ") for size in sizes for known in ("", " known")]
    return [*plain, "fields", "figures", "leader"]


LINES = _line_forms()


def _char_table() -> np.ndarray:
    """The class of every character of the basic plane; what lies beyond is a symbol."""
    fixed = {".": "stop", "!": "stop", "۔": "stop", "؟": "stop", ":": "stop", ",": "comma", "،": "comma", "'": "apostrophe", "’": "apostrophe", '"': "apostrophe", "“": "apostrophe", "”": "apostrophe",
             "|": "separator", "\t": "separator", ";": "separator", "?": "query", "�": "lost", "\n": "newline", "‌": "blank", "‍": "blank"}
    out = np.full(0x10000, CHARS.index("symbol"), np.uint8)
    for i in range(0x10000):
        c = chr(i)
        kind = unicodedata.category(c)
        if c in fixed:
            name = fixed[c]
        elif 0x80 <= i < 0x100:
            name = "control" if i < 0xA0 else "latin1"
        elif kind[0] in "LM":
            name = "lower" if kind == "Ll" else "upper" if kind in ("Lu", "Lt") else "caseless"
        else:
            name = {"Nd": "digit", "Pd": "dash", "Ps": "bracket", "Pe": "bracket", "Zs": "blank", "Cc": "control", "Zl": "newline", "Zp": "newline"}.get(kind, "blank" if c.isspace() else "symbol")
        out[i] = CHARS.index(name)
    return out


_tables: list[np.ndarray] = []
_letters = np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x10000)])


def _classes(codes: np.ndarray) -> np.ndarray:
    if not _tables:
        _tables.append(_char_table())
    return _tables[0][np.where(codes < 0x10000, codes, 0)] * (codes < 0x10000) + (codes >= 0x10000) * np.uint8(CHARS.index("symbol"))


def _form(token: str) -> str:
    """The form of a token, by its characters alone."""
    letters = sum(c.isalpha() for c in token)
    digits = sum(c.isdigit() for c in token)
    if len(token) > _ENDLESS and token.isascii():
        return "leader" if set(token) <= set("._-…") else "endless"
    if "�" in token or any(c == "?" and token[i + 1 : i + 2].isalpha() for i, c in enumerate(token)):
        return "damaged"
    if any("\x80" <= c < "\xa0" or c in "ÃÂØÙÚÛâ€" for c in token):
        return "foreign"
    if len(token) >= 3 and set(token) <= set(".…"):
        return "leader"
    if not letters and not digits:
        return "mark" if len(token) == 1 else "symbol"
    if letters + digits < 0.5 * len(token):
        return "symbol"
    if not letters:
        return "figure"
    if digits:
        return "figured"
    first = next(c for c in token if c.isalpha())
    if first.islower():
        return "lower"
    if not first.isupper():
        return "caseless"
    return "upper" if letters > 1 and token.isupper() else "capital"


_EDGES = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum()) + "“”‘’۔،؟—–…"


class Reader:
    """Turns batches of texts into counts and distributions; remembers what it knows of the tokens it has met.

    ``languages`` gives the function words of each language, fixed tables of a few dozen words.
    """

    def __init__(self, languages: dict[str, list[str]]) -> None:
        self.names = sorted(languages)
        self.known = {w.lower(): k for k, lang in reversed(list(enumerate(self.names))) for w in languages[lang]}
        self.met: dict[str, int] = {}
        self.blocks = {"words": [*self.names, "other"], "forms": FORMS, "chars": CHARS, "lines": LINES, "repeats": REPEATS}
        self.columns = [f"{b}:{c}" for b, names in self.blocks.items() for c in names]

    def _meet(self, token: str) -> int:
        """What is known of a token, packed: form, function word of which language (0 for none), whether it can number or mark a line."""
        bare = token.strip(_EDGES)
        lang = self.known.get(bare.lower(), -1) + 1
        body = token.strip("()[]")
        number = len(token) <= 6 and body[:-1].isdigit() and body[-1:] in ".):-–۔" or token[-1:] in ").]" and len(bare) <= 3 and bool(bare) and (bare.isdigit() or len(bare) == 1 or set(bare.lower()) <= set("ivx")) and len(token) <= 6
        mark = token in ("•", "·", "▪", "◦", "*", "‣", "–", "—", "-", "o")
        end = token[-1] in _STOPS or len(token) > 1 and token[-1] in "\"'”’)" and token[-2] in _STOPS
        packed = FORMS.index(_form(token)) | lang << 4 | (1 if number else 2 if mark else 0) << 12 | end << 14
        if len(self.met) > 300_000:
            self.met.clear()
        if len(token) <= 60:
            self.met[token] = packed
        return packed

    def read(self, texts: list[str | None]) -> tuple[pd.DataFrame, np.ndarray]:
        """(counts of each text, its distributions side by side in the order of ``columns``); all 0 for null and blank texts."""
        n = len(texts)
        flat: list[str] = []
        per_line, line_doc, separators = [], [], []
        for d, text in enumerate(texts):
            for line in (text or "").split("\n"):
                tokens = line.split()
                if tokens:
                    flat += tokens
                    per_line.append(len(tokens))
                    line_doc.append(d)
                    separators.append(line.count("|") + line.count("\t") + line.count(";"))
        seen = list(map(self.met.get, flat))
        if None in seen:
            seen = [self._meet(t) if p is None else p for t, p in zip(flat, seen)]
        packed = np.array(seen, np.int64)
        size = np.fromiter(map(len, flat), np.int64, len(flat))
        per_line, line_doc, separators = np.array(per_line, np.int64), np.array(line_doc, np.int64), np.array(separators, np.int64)
        lines = len(per_line)
        line = np.repeat(np.arange(lines), per_line)
        doc = line_doc[line] if lines else np.zeros(0, np.int64)
        form, lang, place, end = packed & 15, packed >> 4 & 255, packed >> 12 & 3, packed >> 14 & 1

        def spread(rows: np.ndarray, cols: np.ndarray, width: int, weight: np.ndarray | None) -> np.ndarray:
            return np.bincount(rows * width + cols, weights=weight, minlength=n * width).reshape(n, width).astype(float)

        k = len(self.names) + 1
        words = spread(doc, np.where(lang > 0, lang - 1, k - 1), k, None)
        forms = spread(doc, form, len(FORMS), size)
        first = np.cumsum(per_line) - per_line
        known = np.bincount(line, weights=lang > 0, minlength=lines)
        figures = np.bincount(line, weights=form == FORMS.index("figure"), minlength=lines)
        leaders = np.bincount(line, weights=form == FORMS.index("leader"), minlength=lines)
        chars_of_line = np.bincount(line, weights=size, minlength=lines)
        bucket = np.digitize(per_line, [4, 9, 17])
        shape = (place[first] * 4 + bucket) * 2 + (known > 0) if lines else np.zeros(0, np.int64)
        shape = np.where(leaders > 0, LINES.index("leader"), np.where(separators >= 2, LINES.index("fields"), np.where((figures >= 3) & (2 * figures >= per_line), LINES.index("figures"), shape))).astype(np.int64)
        kinds = spread(line_doc, shape, len(LINES), chars_of_line)
        ended = np.bincount(line_doc, weights=end[first + per_line - 1] if lines else None, minlength=n)

        joined = "".join(t or "" for t in texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lens = np.array([len(t or "") for t in texts], np.int64)
        owner = np.repeat(np.arange(n), lens)
        classes = _classes(codes).astype(np.int64)
        chars = spread(owner, classes, len(CHARS), None)
        letter = _letters[np.where(codes < 0x10000, codes, 0)]
        apart = np.ones(len(codes), bool)
        if len(codes):
            apart[1:] = owner[1:] != owner[:-1]
            mid = np.zeros(len(codes), bool)
            mid[1:-1] = ((codes[1:-1] == 0x27) | (codes[1:-1] == 0x2019)) & letter[:-2] & letter[2:] & ~apart[1:-1] & ~apart[2:]
            inside = letter | mid
            begins = inside & (apart | ~np.concatenate([[False], inside[:-1]]))
            n_words = np.bincount(owner[begins], minlength=n)
            in_words = np.bincount(owner[inside], minlength=n)
        else:
            n_words = in_words = np.zeros(n, np.int64)

        repeats = np.zeros((n, 2))
        tokens_of = np.bincount(doc, minlength=n)
        if len(flat) >= 3:
            h = np.fromiter(map(hash, flat), np.int64, len(flat)).astype(np.uint64)
            triple = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
            at = doc[:-2]
            whole = at == doc[2:]
            order = np.lexsort((triple[whole], at[whole]))
            t, d = triple[whole][order], at[whole][order]
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
            repeats[:, 0] = np.bincount(d[new], minlength=n)
            repeats[:, 1] = np.bincount(d, minlength=n) - repeats[:, 0]
        repeats[:, 0] += (tokens_of > 0) * 1.0  # a text of one or two tokens repeats nothing

        rows = [x / np.maximum(x.sum(axis=1, keepdims=True), 1) for x in (words, forms, chars, kinds, repeats)]
        solid = chars.sum(axis=1) - chars[:, CHARS.index("blank")] - chars[:, CHARS.index("newline")] - _tabs(texts)
        plain = chars[:, : CHARS.index("digit") + 1].sum(axis=1)
        counts = pd.DataFrame({
            "n_words": n_words, "mean_word_length": in_words / np.maximum(n_words, 1), "symbol_ratio": np.where(solid > 0, np.maximum(solid - plain, 0) / np.maximum(solid, 1), 0.0),
            "end_punct_share": ended / np.maximum(np.bincount(line_doc, minlength=n), 1), "common_share": np.minimum(1.0, (tokens_of - words[:, k - 1]) / np.maximum(n_words, 1)),
            "n_lines": np.bincount(line_doc, minlength=n), "_blank": tokens_of == 0,
        })
        return counts, np.concatenate(rows, axis=1).astype(np.float32)


def _tabs(texts: list[str | None]) -> np.ndarray:
    return np.array([(t or "").count("\t") for t in texts])


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log2(np.maximum(x, 1e-30))


def divergences(rows: np.ndarray, profiles: np.ndarray, weight: np.ndarray, chunk: int = 512) -> np.ndarray:
    """Weighted sum of the Jensen-Shannon divergences in bits of the distributions of each row from those of each profile."""
    own, theirs = _xlogx(rows) @ weight, _xlogx(profiles) @ weight
    out = np.empty((len(rows), len(profiles)), np.float32)
    for at in range(0, len(rows), chunk):
        part = rows[at : at + chunk]
        for j, q in enumerate(profiles):
            out[at : at + chunk, j] = (own[at : at + chunk] + theirs[j]) / 2 - _xlogx((part + q) / 2) @ weight
    return np.maximum(out, 0)


@dataclass
class Profiles:
    """Fitted profiles: a name, a verdict and the distributions of each; of a fixed greatest size, whatever they were fitted on."""

    names: list[str]
    verdicts: list[str]
    rows: np.ndarray
    weight: np.ndarray

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest profile, its divergence); ties go to the earlier profile."""
        gaps = divergences(rows, self.rows, self.weight)
        best = gaps.argmin(axis=1)
        return best, gaps[np.arange(len(rows)), best]


def _means(rows: np.ndarray, start: np.ndarray, weight: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Centres of rows by k-means under the divergence, begun at ``start``."""
    centres = start
    for _ in range(rounds):
        near = divergences(rows, centres, weight).argmin(axis=1)
        centres = np.stack([rows[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))])
    return centres


def fit_profiles(rows: np.ndarray, labels: list[str], reader: Reader) -> Profiles:
    """Profiles of labelled rows. Prose is parted by its language first; a kind starts with PROFILES centres, as far from
    each other as its rows allow, and gets another where rows of it are nearer to a profile of another verdict."""
    weight = np.concatenate([np.full(len(names), WEIGHTS[b]) for b, names in reader.blocks.items()]).astype(np.float32)
    langs = rows[:, : len(reader.names)]
    kinds = np.array([f"prose_{reader.names[k]}" if y == "prose" and reader.names else y for y, k in zip(labels, langs.argmax(axis=1) if reader.names else np.zeros(len(rows), int))])
    groups = {kind: rows[kinds == kind] for kind in sorted(set(kinds))}
    centres: dict[str, np.ndarray] = {}
    for kind, own in groups.items():
        start = own.mean(axis=0, keepdims=True)
        while len(start) < min(PROFILES, len(own)):
            far = divergences(own, start, weight).min(axis=1)
            if far.max() < 1e-3:
                break
            start = np.concatenate([start, own[[far.argmax()]]])
        centres[kind] = _means(own, start, weight)

    def assembled() -> Profiles:
        names = [f"{kind}_{i}" for kind, c in centres.items() for i in range(len(c))]
        verdicts = [kind.split("_")[0] for kind, c in centres.items() for _ in c]
        return Profiles(names, verdicts, np.concatenate(list(centres.values())).astype(np.float32) if centres else np.zeros((0, rows.shape[1]), np.float32), weight)

    for _ in range(8):
        now = assembled()
        changed = False
        for kind, own in groups.items():
            verdict = np.array(now.verdicts)[now.nearest(own)[0]]
            lost = own[verdict != kind.split("_")[0]]
            if len(lost) and len(centres[kind]) < MOST_PROFILES:
                gap = divergences(lost, centres[kind], weight).min(axis=1)
                near = lost[divergences(lost, lost[[gap.argmax()]], weight)[:, 0] <= gap.max() / 2]
                centres[kind] = np.concatenate([centres[kind], near.mean(axis=0, keepdims=True)])
                changed = True
        if not changed:
            break
    return assembled()


def learn_profiles(texts: DataFrame, languages: dict[str, list[str]]) -> Profiles:
    """Profiles fitted to the SAMPLE rows (doc_id, text) with the smallest hashes of their ids. The rows are read and labelled
    where they lie; only their labels and distributions reach the driver. An empty table gives no profiles."""
    total = texts.count()
    share = min(1.0, (1.25 * SAMPLE + 50) / max(total, 1))
    h = F.xxhash64("doc_id")
    picked = texts.where((h <= F.lit(min(2**63 - 1, int(-(2**63) + share * (2**64 - 1))))) & (F.length(F.trim("text")) > 0)).withColumn("_h", h)
    words = frozenset(w.lower() for ws in languages.values() for w in ws)

    def look(batches):
        reader = Reader(languages)
        for batch in batches:
            _, rows = reader.read(list(batch["text"]))
            yield pd.DataFrame({"_h": batch["_h"], "doc_id": batch["doc_id"], "label": [label(t, words) for t in batch["text"]], "row": list(rows)})

    found = picked.select("_h", "doc_id", "text").repartition(shuffle_width(texts.sparkSession)).mapInPandas(look, "_h bigint, doc_id bigint, label string, row array<float>").orderBy("_h", "doc_id").limit(SAMPLE).collect()
    reader = Reader(languages)
    return fit_profiles(np.array([r["row"] for r in found], np.float32).reshape(len(found), len(reader.columns)), [r["label"] for r in found], reader)


def describe(texts: list[str | None], reader: Reader, profiles: Profiles) -> pd.DataFrame:
    """Counts, divergence, nearest profile and verdict of each text; null and blank texts have counts of 0 and no verdict."""
    out, rows = reader.read(texts)
    blank = out.pop("_blank").to_numpy()
    if not len(profiles.names):
        return out.assign(divergence=None, profile=None, text_class=None)
    best, gap = profiles.nearest(rows)
    out["divergence"] = np.where(blank, None, np.round(gap.astype(float), 6))
    out["profile"] = np.where(blank, None, np.array(profiles.names, object)[best])
    out["text_class"] = np.where(blank, None, np.array(profiles.verdicts, object)[best])
    return out


STATS_SCHEMA = (
    "doc_id bigint, n_words int, mean_word_length double, symbol_ratio double, end_punct_share double, common_share double, n_lines int, divergence double, profile string, text_class string"
)
#: Texts that are read at a time.
CHUNK = 1024


def text_stats(texts: DataFrame, languages: dict[str, list[str]], profiles: Profiles, verdicts: list[str] | None = None) -> DataFrame:
    """Statistics and verdict of every row (doc_id, text), read once; with ``verdicts`` only the rows (doc_id, text_class) of those."""

    def look(batches):
        reader = Reader(languages)
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.iloc[at : at + CHUNK]
                out = describe(list(part["text"]), reader, profiles)
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield out if verdicts is None else out.loc[out["text_class"].isin(verdicts), ["doc_id", "text_class"]]

    return texts.select("doc_id", "text").mapInPandas(look, STATS_SCHEMA if verdicts is None else "doc_id bigint, text_class string")
