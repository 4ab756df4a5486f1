"""Labels for a bounded sample of documents, by the looks of their lines and sentences.

They are training labels alone: the profiles of ``textstats`` are fitted on them, and the divergence from the
profiles decides on every document.
"""

from __future__ import annotations

import re
from collections import Counter

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_MARK = re.compile(r"^\s*(?:[\(\[]?\d{1,4}(?:\s*[.)\]:۔]|\s*[-–]\s)|[\(\[]?[a-zA-Zivx]{1,3}[.)\]]|[•·▪◦*‣–—-]|o(?=\s))\s*")
_LEADERS = re.compile(r"(?:\.\s?){4,}\s*\d+\s*$|\s\.{3,}\s*\d+\s*$")
_CITE = re.compile(r"^\W*(?:[A-Z][A-Za-z.]{1,6}\s+(?:18|19|20)\d\d\s+[A-Za-z.\s]{0,22}\d+|(?:18|19|20)\d\d\s+[A-Z][A-Za-z.]{1,6}\s+\d+)\W*$")
_NUMERIC = re.compile(r"^[-–—]?$|^[\d.,:/%$()+-]*\d[\d.,:/%$()+-]*$")
_CLEAN = re.compile(r"[^\W\d_]{3,}|\d{2,}")
_FIELDS = re.compile(r"\s*[|;\t]\s*|\s{3,}")
_SENTENCE = re.compile(r"(?<=[.!?۔])\s+")
_DAMAGE = re.compile(r"�|\?(?=[^\W_])|(?<=[^\W_])\?(?=\?)|(?<=\s)\?+(?=[\s?])")
_MOJI = re.compile(r"[ÃÂØÙÚÛâ][\x80-\xbf\u0080-ÿŒœŠšŸŽžƒˆ˜–-…‰‹›€™]")
_SUSPECT = re.compile(r"[?�ÃÂØÙÚÛâ]|(?:^|\s)[^\w\s]{2,}(?:\s|$)")
_UNBROKEN = 30
_ITEM_WORDS = 8


def _fields(line: str) -> int:
    return sum(1 for f in _FIELDS.split(line) if f.strip())


def _is_row(line: str) -> bool:
    """A line of several fields: by separators, or of figures of which one has a point, comma or per cent sign."""
    if _CITE.match(line):
        return False
    if ("|" in line or "\t" in line or ";" in line or "   " in line) and _fields(line) >= 3 and not _LEADERS.search(line):
        return True
    tokens = line.split()
    figures = [t for t in tokens if _NUMERIC.match(t)]
    return len(figures) >= 3 and len(figures) * 2 >= len(tokens) and any(re.search(r"\d[.,%]", t) for t in figures)


def _is_noise(line: str) -> bool:
    """A line of which less than a third is words of three letters or figures of two digits; leader dots aside."""
    bare = re.sub(r"\.{3,}|(?:\.\s){3,}", "", line)
    solid = sum(map(len, bare.split()))
    return solid >= 12 and 3 * sum(map(len, _CLEAN.findall(bare))) < solid and not _MOJI.search(bare) and "�" not in bare


def _shape(line: str, words: list[str], common: float) -> str:
    """What kind of list item a line could be; '' where it reads as a sentence."""
    mark = _MARK.match(line)
    body = line[mark.end() :] if mark else line
    if _LEADERS.search(line):
        return "leaders"
    if _CITE.match(body):
        return "citation"
    if mark and (len(words) <= _ITEM_WORDS or (common < 0.12 and len(words) <= 16)):
        head = line[: mark.end()].strip()
        return "number" if any(ch.isdigit() for ch in head) else "mark" + head
    if words and len(words) <= 5 and common == 0 and not line.rstrip().endswith((".", ":", "۔")) and all(w[0].isupper() or not w.isascii() for w in words):
        return "name"
    if words and len(words) <= 6 and not line.rstrip().endswith((".", "۔", ",", ":")) and common == 0:
        return "short"
    return ""


def label(text: str, function_words: frozenset[str]) -> str:
    """prose, list, table or junk: what more than half of the characters of the text look like."""
    mass: Counter = Counter()
    for kind, n in _masses([x for x in text.split("\n") if x.strip()], function_words):
        mass[_VERDICTS.get(kind, "junk")] += n
    if not mass:
        return "junk"
    return max(sorted(mass), key=lambda k: mass[k])


_VERDICTS = {"function": "prose", "word": "prose", "item": "list", "row": "table"}


def _masses(lines: list[str], function_words: frozenset[str]):
    """(class, characters) pairs. Heading-like lines that are neither item nor sentence count for nothing."""
    if len(lines) == 1 and not _is_noise(lines[0]) and (lines[0].count(",") >= 3 or lines[0].count(";") >= 3):
        parts = [x for x in re.split(r"[,;]\s*", lines[0]) if x.strip()]
        plain = sum(not any(w.lower() in function_words for w in _WORD.findall(x)) and len(_WORD.findall(x)) <= 5 for x in parts)
        if plain >= 0.8 * len(parts) and len(parts) >= 4:
            lines = parts
    read = []
    for line in lines:
        words = _WORD.findall(line)
        if _is_noise(line):
            yield "symbol", len(line.strip())
            continue
        if len(words) >= 10 and len({w.lower() for w in words}) <= max(2, min(20, 0.1 * len(words))):
            yield "repeated", len(line.strip())
            continue
        share = sum(w.lower() in function_words for w in words) / len(words) if words else 0.0
        row = _is_row(line)
        read.append((line, words, share, row, "" if row else _shape(line, words, share)))
    rows = sum(r[3] for r in read)
    shapes = Counter(r[4] for r in read if r[4])
    sentences = sum(not r[3] and not r[4] for r in read)
    before: set[str] = set()
    for line, words, share, row, shape in read:
        n = len(line.strip())
        if row and rows >= 2:
            yield "row", n
            continue
        if shape and shapes[shape] >= 3 and (shape != "short" or shapes[shape] > sentences) and not _MOJI.search(line) and "�" not in line:
            if shape != "name" or shapes[shape] > 2:
                yield "item", n
                continue
        if shape and len(words) <= _ITEM_WORDS and len(read) > 1 and shapes[shape] < 3 and "�" not in line and sum(map(len, words)) * 2 >= n:
            continue  # a heading
        for sentence in _SENTENCE.split(line.strip()):
            if sentence in before and len(sentence) > 12:
                yield "repeated", len(sentence)
                continue
            before.add(sentence)
            yield from _sentence(sentence, function_words)


def _sentence(sentence: str, function_words: frozenset[str]):
    tokens = sentence.split()
    bare = [_WORD.findall(t) for t in tokens]
    flat = [w.lower() for ws in bare for w in ws]
    functional = sum(w in function_words for w in flat)
    lost = len(flat) >= 8 and functional * 25 < len(flat)  # a long run of words with no function word among them
    if not lost and tokens and max(map(len, tokens)) <= _UNBROKEN and not _SUSPECT.search(sentence):
        known = sum(len(w) for w in flat if w in function_words)
        yield "function", known
        yield "word", sum(map(len, tokens)) - known
        return
    for token, ws in zip(tokens, bare):
        n = len(token)
        letters = sum(map(len, ws))
        if "�" in token or _DAMAGE.search(f" {token} "):
            yield "damaged", n
        elif len(_MOJI.findall(token)) * 2 >= max(2, 0.5 * n) or (n and len(_MOJI.findall(token)) == 1 and n <= 4):
            yield "mojibake", n
        elif n > _UNBROKEN and token.isascii():
            yield "unbroken", n
        elif letters * 2 < n and not any(ch.isdigit() for ch in token):
            yield "symbol", n
        elif any(w.lower() in function_words for w in ws):
            yield "function", n
        elif lost and not token[:1].isupper() and token[:1].isalpha():
            yield "nonword", n
        elif letters == 0 and len(token) > 1 and sum(ch.isdigit() for ch in token) * 2 < n:
            yield "symbol", n
        else:
            yield "word", n
