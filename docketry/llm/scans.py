"""Noise in text from scanned pages: cut words, misread characters, running heads and page numbers.

Words are corrected as messages through a noisy channel: a table of character confusions says what a word may have
been read as, counts of words and word pairs over the whole corpus say what was likely written, and Viterbi's
algorithm picks the best sequence of candidates along each line.

The counts stay distributed. A record is read with the answers it has and asks for what it lacks; the questions are
joined with the counts and the record is read again, until none has a question left.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.session import checkpointed

# What a character is misread as, with the probability of that reading per character.
CONFUSIONS = [
    ("e", "c", 0.004), ("o", "0", 0.003), ("i", "!", 0.003), ("n", "ri", 0.003), ("d", "cl", 0.003), ("s", "5", 0.002), ("l", "1", 0.002), ("u", "ii", 0.003), ("h", "b", 0.003),
    ("m", "rn", 0.003), ("g", "9", 0.002), ("w", "vv", 0.002), ("li", "h", 0.002), ("tt", "lt", 0.001), ("fi", "ﬁ", 0.01), ("fl", "ﬂ", 0.01), ("b", "8", 0.001), ("a", "@", 0.001), ("i", "|", 0.001),
]

#: A word or pair counts from this number of occurrences on, however large the corpus is.
LEAST = 4
#: A word that is itself common may still be a reading of one that is this many times as common.
RATIO = 25.0
#: Bits of the filter that tells words without a candidate; a fuller filter costs questions, not results.
_FILTER_BITS, _FILTER_PART = 1 << 26, 1 << 16

HYPHENS = "-­¬‐"
_TOKEN = re.compile(r"[^\W_](?:[^\s.,;:()\[\]\"“”—–\\/_]*[^\s.,;:()\[\]\"“”?—–\\/_])?")
_HYPHEN_END = re.compile(rf"([^\W\d_]+(?:-[^\W\d_]+)*)([{HYPHENS}])\s*$")
_PAGE_NO = re.compile(r"^(?:[-–—]\s*\d{1,4}\s*[-–—]|\(\s*\d{1,4}\s*\)|\[\s*\d{1,4}\s*\]|page\s+\d{1,4}(?:\s+of\s+\d{1,4})?|\d{1,4})$", re.I)
_SIDE_NO = re.compile(r"^(?:(\d{1,4})\s{2,}(\S.*)|(\S.*?)\s{2,}(\d{1,4}))$")
_PART = re.compile(r"^(?:\[\s*(?:sec|part|chap|chapter|art|rule)\.?\s+[\divxlc]+(?:-?[a-z]{1,2})?\s*\]?|(?:sec|part|chap|chapter|art|rule)\.?\s+[\divxlc]+(?:-?[a-z]{1,2})?\s*\])$", re.I)
_ACT_NAME = re.compile(r"^(?:[A-Z][a-z]+ )(?:(?:[A-Z][a-z]+|and|of|for|the) ){0,7}(?:\([A-Z][a-z]+(?: [A-Z][a-z]+)*\) )?(?:Act|Ordinance|Order|Rules|Regulations|Code)$")
_DOCKET = re.compile(r"^[A-Z][A-Za-z. ]{0,12}\s?No\.\s*\d+\S*\s+of\s+\d{4}$", re.I)
_CITE = re.compile(r"^(?:PLD (?:18|19|20)\d\d [A-Za-z. ]{2,24} \d+|(?:18|19|20)\d\d [A-Z][A-Za-z]{2,5} \d+)$", re.I)
_VERSUS = re.compile(r"^\S.{2,70}\s(?:v\.|vs\.?|versus)\s\S.{2,70}$", re.I)
# the first look: a figure or bracket at either end, a name or number of an act or case
_ODD = re.compile(r"^[\[(–—-]|^\d{1,4}(?:\s{2,}|$)|.*\s{2,}\d{1,4}$|^(?:sec|part|chap|page|art|rule)\b|^[A-Z].*(?:Act|Ordinance|Order|Rules|Regulations|Code|\d)$|.*\s(?:v\.|vs\.?|versus)\s", re.I)
_WEB = re.compile(r"©|all rights reserved|\bcookies\b", re.I)


@dataclass
class Language:
    """Counts of words and word pairs of the corpus."""

    words: dict[str, int]
    pairs: dict[tuple[str, str], int]
    total: int


_BREAKS = '.,;:()[]"“”?—–\\/_'


def words_of(text: str) -> list[str]:
    low = text.lower()
    for c in _BREAKS:
        if c in low:
            low = low.replace(c, " ")
    return low.split()


def spellings(text: str, words: Iterable[str]) -> set[str]:
    """All forms in which words of the text are looked up: its ``words`` and the tokens that a line is decoded by."""
    out = set(words)
    for w in [w for w in out if not w[0].isalnum()]:
        out.update(_TOKEN.findall(w))
    if "?" in text:
        out.update(m.lower() for m in _TOKEN.findall(text))
    return out


_PARTS = (("m", "rri"), ("n", "ri"), ("d", "el"), ("u", "ii"), ("h", "li"), ("w", "vv"), ("ﬁ", "fi"), ("ﬂ", "fl"))


def _skeleton(word: Column) -> Column:
    """A key that is the same for a word and all its readings: both sides of every confusion spelled out alike."""
    out = F.translate(word, "c0!|51t9@8b", "eoiisllgahh")
    for char, parts in _PARTS:
        out = F.replace(out, F.lit(char), F.lit(parts))
    return out


def _readable(w: str) -> bool:
    """Whether the word is long enough to be a misreading."""
    letters = sum(c.isalpha() for c in w)
    return len(w) >= 3 and letters >= 2 or len(w) == 2 and letters == 1


class _Looked:
    """Counts read one by one where they lie."""

    def __init__(self, grams: DataFrame) -> None:
        self.grams = grams

    def __getitem__(self, key: str | tuple[str, str]) -> int:
        a, b = key if isinstance(key, tuple) else (key, None)
        got = self.grams.where((F.col("a") == a) & F.col("b").eqNullSafe(F.lit(b)) & (F.col("n") >= LEAST)).first()
        if got is None:
            raise KeyError(key)
        return got["n"]


class CorpusLanguage:
    """Counts of words and word pairs of the corpus as a table (a, b, n), b null for words; words below LEAST are in it as suspects only."""

    def __init__(self, grams: DataFrame) -> None:
        self.grams = grams
        self.total = max(int(grams.where((F.col("n") >= LEAST) & F.col("b").isNull()).agg(F.sum("n")).first()[0] or 0), 1)
        self.words = self.pairs = _Looked(grams)

    def _counted(self) -> DataFrame:
        """(a, n) of all spellings, n 0 below LEAST."""
        return self.grams.where("b is null").select("a", F.when(F.col("n") >= LEAST, F.col("n")).otherwise(0).alias("n"))

    def _mates(self, own: DataFrame, how: str) -> DataFrame:
        """The words (a, n) with those of the corpus that could have been written (y, m)."""
        written = self._counted().where((F.col("n") > 0) & (F.col("a").rlike(r"^\p{L}+$") | F.contains("a", F.lit("-")))).select(F.col("a").alias("y"), F.col("n").alias("m"), _skeleton(F.col("a")).alias("_s"))
        own = own.where(F.length("a") >= 2).withColumn("_s", _skeleton(F.col("a")))
        common = F.col("m") >= RATIO * F.col("n") * F.when(F.length("a") > 2, 1).otherwise(20)
        return own.join(written, (own["_s"] == written["_s"]) & (F.col("a") != F.col("y")) & common, how)

    def suspect_filter(self) -> bytes:
        """A filter of fixed size that holds every spelling of the corpus with a mate."""
        at = self._mates(self._counted(), "left_semi").select((F.crc32(F.encode("a", "UTF-8")) % _FILTER_BITS).alias("p"))
        parts = at.groupBy((F.col("p") / _FILTER_PART).cast("int").alias("part")).agg(F.collect_set((F.col("p") % _FILTER_PART).cast("int")).alias("bits"))

        def pack(batches):
            for batch in batches:
                rows = []
                for part, bits in zip(batch["part"], batch["bits"]):
                    held = bytearray(_FILTER_PART // 8)
                    for p in bits:
                        held[p >> 3] |= 1 << (p & 7)
                    rows.append((part, bytes(held)))
                yield pd.DataFrame(rows, columns=["part", "held"])

        out = bytearray(_FILTER_BITS // 8)
        for r in parts.mapInPandas(pack, "part int, held binary").toLocalIterator():
            out[r["part"] * _FILTER_PART // 8 : (r["part"] + 1) * _FILTER_PART // 8] = r["held"]
        return bytes(out)

    def answers(self, questions: DataFrame) -> DataFrame:
        """(rid, answers) to questions (rid, asked), each a word or a pair with a blank between."""
        asked = questions.select("rid", F.split("asked", " ")[0].alias("a"), F.get(F.split("asked", " "), F.lit(1)).alias("b"))
        words = asked.where("b is null").select("a").distinct().join(self._counted(), "a", "left").select("a", F.coalesce("n", F.lit(0)).alias("n"))
        words = checkpointed(words)
        mates = self._mates(words, "inner").groupBy("a", "n").agg(F.collect_list("y").alias("y"), F.collect_list("m").alias("m"))

        def choose(batches):
            for batch in batches:
                rows = []
                for a, n, y, m in zip(batch["a"], batch["n"], batch["y"], batch["m"]):
                    known = dict(zip(y, map(int, m)))
                    rows.append((a, json.dumps([(x, c, known[x]) for x, c in _readings(a, known, int(n))])))
                yield pd.DataFrame(rows, columns=["a", "found"])

        words = words.join(mates.mapInPandas(choose, "a string, found string"), "a", "left")
        one = asked.where("b is null").select("rid", "a").join(words, "a").select("rid", F.col("a").alias("asked"), "n", "found")
        pairs = self.grams.where("b is not null")
        two = asked.where("b is not null").join(pairs, ["a", "b"], "left").select("rid", F.concat_ws(" ", "a", "b").alias("asked"), F.coalesce("n", F.lit(0)).alias("n"), F.lit(None).cast("string").alias("found"))
        return one.unionByName(two).groupBy("rid").agg(F.collect_list(F.to_json(F.struct("asked", "n", "found"))).alias("answers"))


def count_language(texts: DataFrame) -> CorpusLanguage:
    """Counts over all texts (column ``text``); each task adds its own up before anything is shuffled."""

    def count(batches):
        for batch in batches:
            ids: dict[str, int] = {}
            flat: list[int] = []
            starts: list[int] = []
            odd: set[str] = set()
            for t in batch["text"]:
                if t:
                    starts.append(len(flat))
                    flat += [ids.setdefault(w, len(ids)) for w in words_of(t)]
                    if "?" in t:
                        odd |= spellings(t, ())
            words, at = np.array(list(ids), object), np.array(flat, np.int64)
            within = np.ones(max(len(at) - 1, 0), bool)
            within[[x - 1 for x in starts if 0 < x < len(at)]] = False
            pairs, n = np.unique((at[:-1] * max(len(ids), 1) + at[1:])[within], return_counts=True)
            one = np.bincount(at, minlength=len(ids))
            none = [w for w in (odd | spellings("", ids)) if w not in ids]
            yield pd.DataFrame({"a": [*words, *none, *words[pairs // max(len(ids), 1)]], "b": [*[None] * (len(ids) + len(none)), *words[pairs % max(len(ids), 1)]], "n": np.concatenate([one, np.zeros(len(none), np.int64), n])})

    grams = texts.where(F.col("text").isNotNull()).select("text").mapInPandas(count, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return CorpusLanguage(checkpointed(grams.where((F.col("n") >= LEAST) | F.col("b").isNull())))


_BY_LAST: dict[tuple[str, str], list[tuple[str, str, float]]] = {}
for _written, _read, _p in CONFUSIONS:
    _BY_LAST.setdefault((_written[-1], _read[-1]), []).append((_written, _read, math.log(_p)))


def channel(written: str, read: str) -> float | None:
    """Log-probability of the likeliest way in which one word is read as another through the confusions; None where there is none.

    The words are aligned from left to right; equal characters cost nothing. Any number of confusions is allowed.
    """
    rows = [[-math.inf] * (len(read) + 1) for _ in range(len(written) + 1)]
    rows[0][0] = 0.0
    for i in range(1, len(written) + 1):
        a = written[i - 1]
        for j in range(1, len(read) + 1):
            b = read[j - 1]
            best = rows[i - 1][j - 1] if a == b else -math.inf
            for w, r, cost in _BY_LAST.get((a, b), ()):
                if i >= len(w) and j >= len(r) and written[i - len(w) : i] == w and read[j - len(r) : j] == r:
                    best = max(best, rows[i - len(w)][j - len(r)] + cost)
            rows[i][j] = best
    return rows[-1][-1] if rows[-1][-1] > -math.inf else None


def _readings(w: str, known: dict[str, int], own: int) -> list[tuple[str, float]]:
    """[(word that may have been written, log-probability of this reading of it)] among all the ``known`` words; ``own`` is the word's own count."""
    if not _readable(w):
        return []
    found = []
    for y, n in known.items():
        if y != w and n >= LEAST and n >= RATIO * own * (1 if len(w) > 2 else 20) and y.isalpha() | ("-" in y):
            cost = channel(y, w)
            if cost is not None:
                found.append((y, cost))
    return sorted(found, key=lambda x: (-x[1], x[0]))


_ALIKE = str.maketrans("c0!|51t9@8b", "eoiisllgahh")


def skeleton(word: str) -> str:
    """``_skeleton`` of one word."""
    out = word.translate(_ALIKE)
    for char, parts in _PARTS:
        out = out.replace(char, parts)
    return out


class Corrector:
    """Decodes lines under a language; remembers the candidates of the words it has met."""

    def __init__(self, language: Language) -> None:
        self.lm = language
        self.seen: dict[str, list[tuple[str, float]]] = {}
        self.plain: set[str] = set()
        self.alike: dict[str, dict[str, int]] | None = None
        self.floor = math.log(0.3 / language.total)

    def _log_word(self, w: str) -> float:
        n = self.lm.words.get(w)
        return math.log(n / self.lm.total) if n else self.floor - 0.4 * len(w)

    def candidates(self, w: str) -> list[tuple[str, float]]:
        """[(word that may have been written, log-probability of this reading of it)], the word as it stands first."""
        got = self.seen.get(w)
        if got is not None:
            return got
        if len(self.seen) > 400_000:
            self.seen.clear()
        if self.alike is None:
            self.alike = {}
            for y, n in self.lm.words.items():
                self.alike.setdefault(skeleton(y), {})[y] = n
        got = self.seen[w] = [(w, math.log(0.97)), *_readings(w, self.alike.get(skeleton(w), {}), self.lm.words.get(w, 0))]
        return got

    def suspects(self, text: str) -> bool:
        """Whether any word of the text could be a misreading."""
        found = False
        for w in set(words_of(text)) - self.plain:
            if len(self.candidates(w)) == 1:
                self.plain.add(w)
            else:
                found = True
        if len(self.plain) > 1_000_000:
            self.plain.clear()
        return found

    def decode(self, line: list[str]) -> list[str]:
        """The likeliest words of a line by Viterbi's algorithm; the line itself where no word has another candidate."""
        options = [self.candidates(w) for w in line]
        if all(len(o) == 1 for o in options):
            return line
        scores, back = [], []
        for t, choice in enumerate(options):
            row, ptr = [], []
            for word, channel in choice:
                if len(choice) == 1 and (t == 0 or len(options[t - 1]) == 1):  # no choice to weigh
                    row.append(scores[t - 1][0] if t else 0.0)
                    ptr.append(0)
                    continue
                base = self._log_word(word)
                if t == 0:
                    row.append(base + channel)
                    ptr.append(0)
                    continue
                best, arg = -1e18, 0
                for k, (before, _) in enumerate(options[t - 1]):
                    pair = self.lm.pairs.get((before, word))
                    lp = max(base, math.log(pair / (self.lm.words.get(before, 0) + 2))) if pair else base
                    if scores[t - 1][k] + lp > best:
                        best, arg = scores[t - 1][k] + lp, k
                row.append(best + channel)
                ptr.append(arg)
            scores.append(row)
            back.append(ptr)
        k = max(range(len(scores[-1])), key=lambda i: scores[-1][i])
        out = []
        for t in range(len(line) - 1, -1, -1):
            out.append(options[t][k][0])
            k = back[t][k]
        return out[::-1]


class _Answers(dict):
    """Counts that a record was told; a count it was not told is noted as a question and taken as none."""

    def __init__(self, asked: set[str]) -> None:
        super().__init__()
        self.asked = asked

    def get(self, key, default=None):
        if key not in self:
            self.asked.add(" ".join(key) if isinstance(key, tuple) else key)
        return super().get(key, default) or default


class RecordCorrector(Corrector):
    """Decodes one record after another by the answers that each has; ``asked`` holds what the record at hand lacks.

    ``held`` is the filter of the spellings of the corpus with a candidate.
    """

    def __init__(self, total: int, held: bytes) -> None:
        super().__init__(Language({}, {}, total))
        self.held = held

    def begin(self, text: str | None, answers: Iterable[str]) -> None:
        self.text, self.asked, self.seen, self._own = text, set(), {}, None
        self.lm.words, self.lm.pairs = _Answers(self.asked), _Answers(self.asked)
        for answer in map(json.loads, answers):
            a, _, b = answer["asked"].partition(" ")
            if b:
                self.lm.pairs[a, b] = answer["n"]
                continue
            self.lm.words[a] = answer["n"]
            found = json.loads(answer.get("found") or "[]")
            self.seen[a] = [(a, math.log(0.97)), *((y, c) for y, c, _ in found)]
            for y, _, n in found:
                self.lm.words[y] = n

    def _unheld(self, w: str) -> bool:
        p = zlib.crc32(w.encode()) % _FILTER_BITS
        return not self.held[p >> 3] >> (p & 7) & 1

    def candidates(self, w: str) -> list[tuple[str, float]]:
        got = self.seen.get(w)
        if got is not None:
            return got
        if w not in self.plain and _readable(w):
            if self._own is None:
                self._own = spellings(self.text, words_of(self.text))
            if w not in self._own or not self._unheld(w):
                self.asked.add(w)
        return [(w, math.log(0.97))]

    def suspects(self, text: str) -> bool:
        words = set(words_of(text)) - self.plain
        if text is self.text:
            if len(self.plain) > 1_000_000:
                self.plain.clear()
            clear = {w for w in words if not _readable(w) or self._unheld(w)}
            self.plain |= clear
            words -= clear
        return sum(len(self.candidates(w)) > 1 for w in words) > 0


def _prose(line: str) -> bool:
    words = line.split()
    return len(words) >= 5 and sum(w[:1].islower() for w in words) * 2 >= len(words)


def furniture(lines: list[str], caption: bool) -> list[str]:
    """For each line '' or what page layout put there: 'page', 'head' or 'both'.

    ``caption`` says that the text opens with a caption, whose lines look like running heads; there heads are sought
    after the first line of prose only.
    """
    out = [""] * len(lines)
    if len(lines) < 3:
        return out
    at = 0
    if caption:
        at = next((i + 1 for i, x in enumerate(lines) if _prose(x)), len(lines))
    for i in range(at, len(lines)):
        s = lines[i].strip()
        if not s or len(s) > 130 or not (_ODD.match(s) or s.isupper()):
            continue
        if _PAGE_NO.match(s):
            out[i] = "page"
            continue
        side = _SIDE_NO.match(s)
        if _head((side.group(2) or side.group(3)).strip() if side else s, bool(side), lines, i):
            out[i] = "both" if side else "head"
    return out


def _head(s: str, numbered: bool, lines: list[str], i: int) -> bool:
    if not any(c.isalpha() for c in s):
        return False
    if _PART.match(s) or _DOCKET.match(s) or _CITE.match(s):
        return True
    letters = [c for c in s if c.isalpha()]
    if s.upper() == s and (len(s.split()) >= 2 or numbered) and len(letters) >= 5 and any(map(_prose, lines)) and not s.endswith((".", ";", ":")) and letters[0].upper() != letters[0].lower():
        return True
    if _ACT_NAME.match(s):
        after = next((x.strip() for x in lines[i + 1 :] if x.strip()), "")
        return numbered or not after.startswith((",", "(")) and not re.match(r"\d{4}\b", after)
    return bool(_VERSUS.match(s)) and not s.endswith(".") and (numbered or not _prose(s))


def analyse(text: str | None, corrector: Corrector, caption: bool) -> tuple[set[str], str]:
    """(kinds of noise present, the text as continuous paragraphs with the noise undone); null and blank texts have none."""
    if not text or not text.strip():
        return set(), text or ""
    misread = corrector.suspects(text)
    if "\n" not in text and not misread:
        return set(), text
    lines = text.split("\n")
    kinds: set[str] = set()
    marks = furniture(lines, caption)
    cut = any(x[-1:] in HYPHENS and x for x in (line.rstrip() for line in lines))
    if not cut and not misread and not any(marks):
        return kinds, text
    if any(marks) and _WEB.search(text):
        marks = [""] * len(lines)
    for m in marks:
        if m in ("head", "both"):
            kinds.add("header")
        if m in ("page", "both"):
            kinds.add("page_no")
    body, broken = [], False
    for k, (line, m) in enumerate(zip(lines, marks)):
        if m:
            broken = True
            continue
        if not line.strip() and broken and body and not body[-1].rstrip().endswith((".", ":", "۔", "?", "!")):
            continue  # the gap around a page change
        if line.strip():
            broken = False
        body.append(line)
    joined: list[str] = []
    for line in body:
        prior = next((q for q in range(len(joined) - 1, max(-1, len(joined) - 3), -1) if joined[q].strip()), None)
        m = _HYPHEN_END.search(joined[prior]) if cut and prior is not None and line.strip() and joined[prior].rstrip()[-1:] in HYPHENS else None
        nxt = re.match(r"\s*([^\W\d_]+)", line) if m else None
        if m and nxt and (nxt.group(1)[0].islower() or m.group(1).isupper()) and _is_cut(m, nxt.group(1), corrector.lm.words):
            kinds.add("hyphen")
            joined[prior] = joined[prior][: m.end(1)] + line.lstrip()
            del joined[prior + 1 :]
            continue
        joined.append(line)
    # a word cut in two may be misread as a whole only
    misread = misread or "hyphen" in kinds and corrector.suspects("\n".join(joined))
    if not kinds and not misread:
        return kinds, text
    fixed = []
    for line in joined:
        if not misread:
            fixed.append(line.rstrip())
            continue
        spans = [(m.start(), m.end()) for m in _TOKEN.finditer(line)]
        words = [line[a:b] for a, b in spans]
        low = [w.lower() for w in words]
        best = corrector.decode(low) if low else low
        if best != low:
            kinds.add("misread")
            for (a, b), was, now in reversed(list(zip(spans, low, best))):
                if was != now:
                    old = line[a:b]
                    line = line[:a] + (now.upper() if old.isupper() and len(old) > 1 and old.isalpha() else now[:1].upper() + now[1:] if old[:1].isupper() else now) + line[b:]
        fixed.append(line.rstrip())
    return kinds, _paragraphs(fixed)


def _is_cut(m: re.Match, rest: str, words: dict[str, int]) -> bool:
    """Whether the hyphen at a line's end cuts a word: sure for soft hyphens, by the corpus for the plain one."""
    if m.group(2) != "-":
        return True
    head = m.group(1).lower().rpartition("-")[2]
    return words.get(head + rest.lower(), 0) >= words.get(f"{head}-{rest.lower()}", 0)


def _paragraphs(lines: list[str]) -> str:
    """Wrapped lines joined: a line goes on in the next if it ends in no stop and the next begins in lower case or a figure."""
    out: list[str] = []
    for line in lines:
        s = " ".join(line.split())
        if s and out and out[-1] and (s[0].islower() and not (out[-1].isupper() and len(out[-1]) < 40) or (len(out[-1]) > 30 and out[-1][-1] not in ".:;?!۔" and not s.isupper())):
            out[-1] += " " + s
        else:
            out.append(s)
    return "\n".join(out)


def scan_noise(records: DataFrame, language: CorpusLanguage, captions: list[str], repaired: bool = False) -> DataFrame:
    """(source_table, record_id, noise_kind) of the records (source_table, record_id, text), or with ``repaired``
    (source_table, record_id, repaired_text) of the records with noise. Tables in ``captions`` open with a caption."""
    held = records.sparkSession.sparkContext.broadcast(language.suspect_filter())
    opening, total = frozenset(captions), language.total
    columns = ["source_table", "record_id", "found", "text", "answers", "asked"]

    def read(batches):
        corrector = RecordCorrector(total, held.value)
        for batch in batches:
            rows = []
            for table, record, text, answers in zip(batch["source_table"], batch["record_id"], batch["text"], batch["answers"]):
                corrector.begin(text, answers)
                kinds, clean = analyse(text, corrector, table in opening)
                if corrector.asked:
                    rows.append((table, record, None, text, list(answers), sorted(corrector.asked)))
                elif repaired:
                    rows += [(table, record, clean, None, None, None)] if kinds else []
                else:
                    rows += [(table, record, k, None, None, None) for k in sorted(kinds)]
            yield pd.DataFrame(rows, columns=columns)

    schema = "source_table string, record_id string, found string, text string, answers array<string>, asked array<string>"
    todo = records.where(F.length("text") > 0).select("source_table", "record_id", "text", F.array().cast("array<string>").alias("answers"))
    done = []
    while True:
        out = checkpointed(todo.mapInPandas(read, schema))
        done.append(out.where("asked is null").select("source_table", "record_id", F.col("found").alias("repaired_text" if repaired else "noise_kind")))
        left = out.where("asked is not null").withColumn("rid", F.monotonically_increasing_id())
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        told = language.answers(left.select("rid", F.explode("asked").alias("asked"))).withColumnRenamed("answers", "told")
        todo = left.join(told, "rid").select("source_table", "record_id", "text", F.concat("answers", "told").alias("answers"))
