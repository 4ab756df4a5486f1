"""Template residue, filler, error pages and script notices in place of content.

Character n-gram models of natural text, of site matter and of residue give each position of a text three
log-likelihoods; the windows in which the likelihood ratio favours residue are its residue, and a record is residue
if they cover most of what is left once site matter is taken away.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from docketry.llm.seeds import MAIN, RESIDUE, SITE

#: Lengths of the n-grams, buckets of each model, and characters of a window.
ORDERS, TABLE, WINDOW = (3, 5), 1 << 16, 40
#: Share of the text besides site matter from which on a record is residue.
COVERAGE = 0.4
_SMOOTH = 0.02
_PRIMES = np.array([1, 31, 1009, 33391, 1102441, 36380563], np.uint32)


@dataclass
class ResidueModel:
    """Log-probabilities by order, bucket and class: a fixed size, whatever it was fitted on."""

    tables: np.ndarray

    def __post_init__(self) -> None:
        self.memo: dict[str, tuple[int, int]] = {}
        t = self.tables
        #: log-ratios to natural text, of residue as the real and of site matter as the imaginary part
        self.ratios = [(t[o, :, RESIDUE] - t[o, :, MAIN] + 1j * (t[o, :, SITE] - t[o, :, MAIN])).astype(np.complex64) for o in range(len(t))]

    def __reduce__(self):
        return ResidueModel, (self.tables,)


def _codes(leaves: list[str], apart: int = max(ORDERS) - 1) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all leaves, each begun by ``apart`` marks, and where each begins; digits count as one character."""
    pad = "\x02" * apart
    lower = [x.lower() for x in leaves]
    c = np.frombuffer((pad + pad.join(lower)).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[(c >= 48) & (c <= 57)] = 48
    sizes = np.array([len(x) + apart for x in lower])
    return c, np.cumsum(sizes) - sizes


def _grams(c: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that ends at each position."""
    h = c.copy()
    for k in range(1, order):
        h[k:] += c[: len(c) - k] * _PRIMES[k]
    h *= np.uint32(2654435761)
    return (h >> np.uint32(16)).astype(np.int64)


class GramCounts:
    """Occurrences of n-grams by order, class and bucket in labelled leaves: whole numbers, so that the counts of parts add up."""

    def __init__(self) -> None:
        self.n = np.zeros((len(ORDERS), 3, TABLE), np.int64)
        self.waiting: dict[int, list[str]] = {MAIN: [], SITE: [], RESIDUE: []}
        self.size = 0

    def add(self, leaves: list[str], labels: Sequence[int]) -> None:
        for x, y in zip(leaves, labels):
            self.waiting[y].append(x)
            self.size += len(x)
        if self.size >= 60_000:
            self._count()

    def _count(self) -> None:
        for y, leaves in self.waiting.items():
            if leaves:
                c, _ = _codes(leaves)
                real = c != 2
                for o, order in enumerate(ORDERS):
                    self.n[o, y] += np.bincount(_grams(c, order)[real], minlength=TABLE)
                self.waiting[y] = []
        self.size = 0

    def total(self) -> np.ndarray:
        self._count()
        return self.n


def fit(counts: np.ndarray) -> ResidueModel:
    """Models of the three classes from the counts of their n-grams."""
    tables = counts.astype(np.float64)
    total = tables.sum(axis=2, keepdims=True)
    logs = np.log((tables + _SMOOTH) / (total + _SMOOTH * TABLE)).transpose(0, 2, 1)
    return ResidueModel(np.ascontiguousarray(logs, np.float32))


def second_labels(model: ResidueModel, records: list[list[str]], labels: list[Sequence[int] | None]) -> list[Sequence[int] | None]:
    """The labels for a round of self-training: records that are residue by the model are examples of it, unless they were already."""
    out = list(labels)
    hit = is_residue_record(*residue_coverage(model, records))
    for k in np.flatnonzero(hit):
        if labels[k] is None or RESIDUE not in labels[k]:
            out[k] = [SITE if w else RESIDUE for w in _site_leaves(model, records[k])]
    return out


def _site_leaves(model: ResidueModel, leaves: list[str]) -> list[bool]:
    residue, natural = residue_coverage(model, [[x] for x in leaves])
    return [r + n < 0.5 * len(x) or n > r for r, n, x in zip(residue, natural, leaves)]


#: What is known of leaves that were met before: (residue, natural) by text. Windows never cross a leaf, so both depend on
#: its text alone. Only speed depends on the bound.
_MEMO, _MEMO_CHARS = 400_000, 400


def residue_coverage(model: ResidueModel, records: list[list[str]], chunk: int = 60_000) -> tuple[np.ndarray, np.ndarray]:
    """(characters of residue, characters of natural text) of each record, site matter aside. Every distinct leaf is read once."""
    memo = model.memo
    if len(memo) > _MEMO:
        memo.clear()
    fresh = list(dict.fromkeys(x for r in records for x in r if x not in memo))
    got: dict[str, tuple[int, int]] = {}
    at, size = 0, 0
    for k, x in enumerate(fresh):  # so many characters at a time as stay in cache
        size += len(x)
        if size >= chunk or k == len(fresh) - 1:
            got.update(zip(fresh[at : k + 1], zip(*(c.tolist() for c in _leaf_coverage(model, fresh[at : k + 1])))))
            at, size = k + 1, 0
    out = np.zeros((len(records), 2))
    for k, r in enumerate(records):
        residue = natural = 0
        for x in r:
            a, b = got.get(x) or memo[x]
            residue += a
            natural += b
        out[k] = residue, natural
    memo.update((x, v) for x, v in got.items() if len(x) <= _MEMO_CHARS)
    return out[:, 0], out[:, 1]


def _leaf_coverage(model: ResidueModel, leaves: list[str]) -> tuple[np.ndarray, np.ndarray]:
    c, first = _codes(leaves, WINDOW // 2)
    ratios = model.ratios
    scores = ratios[0].take(_grams(c, ORDERS[0]))
    for o, order in enumerate(ORDERS[1:], 1):
        scores += ratios[o].take(_grams(c, order))
    real = c != 2
    scores *= real
    # leaves are half a window apart, so that a window sees one leaf alone
    run = np.zeros(len(c) + 1 + WINDOW, np.complex128)
    np.cumsum(scores, out=run[WINDOW // 2 + 1 : WINDOW // 2 + 1 + len(c)])
    run[WINDOW // 2 + 1 + len(c) :] = run[WINDOW // 2 + len(c)]
    window = run[WINDOW + 1 :] - run[: len(c)]
    residue, site = window.real, window.imag
    bad = real & (residue > 0) & (residue > site)
    main = real & ~bad & (site <= 0)
    return np.add.reduceat(bad, first, dtype=np.int64), np.add.reduceat(main, first, dtype=np.int64)


def is_residue_record(residue: np.ndarray, natural: np.ndarray) -> np.ndarray:
    """Records whose text, site matter aside, is residue for the most part; a record without any text is none."""
    whole = residue + natural
    return (whole > 0) & (residue >= COVERAGE * whole)
