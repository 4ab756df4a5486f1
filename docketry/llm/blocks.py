"""Main content of pages: a bidirectional LSTM in numpy labels every leaf with the whole document as its context.

A leaf is the sum of its hashed word vectors and of the vectors of its tag path and shape; the network reads the
leaves of a document in both directions and gives each the probability of being site matter.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np

BUCKETS, DIM, HIDDEN = 1 << 13, 20, 20
_WORD = re.compile(r"[^\W\d_]+|\d+|©|»|«|\||&gt;|[\[\]{}%#@]")
_DIGIT = re.compile(r"\d")
_cache: dict[str, int] = {}


def _bucket(token: str) -> int:
    k = _cache.get(token)
    if k is None:
        if len(_cache) > 500_000:
            _cache.clear()
        k = _cache[token] = zlib.crc32(token.encode()) % BUCKETS
    return k


_paths: dict[tuple[str, ...], list[int]] = {}
_CONTAINERS = frozenset(("nav", "aside", "footer", "header", "form", "main", "ul", "table", "center", "small", "article"))


def _path_buckets(path: tuple[str, ...]) -> list[int]:
    got = _paths.get(path)
    if got is None:
        if len(_paths) > 100_000:
            _paths.clear()
        names = ["path " + "/".join(path[-1:]), "path2 " + "/".join(path[-2:]), "path3 " + "/".join(path[-3:])]
        names += sorted(f"in {t}" for t in {x.split(".")[0] for x in path} & _CONTAINERS)
        got = _paths[path] = [_bucket("\x01" + x) for x in names]
    return got


_pieces: dict[str, list[int]] = {}


def _word_buckets(piece: str) -> list[int]:
    """Buckets of the words of a piece of text without white space."""
    got = [_bucket(w) for w in _WORD.findall(_DIGIT.sub("0", piece).lower())]
    if len(_pieces) > 400_000:
        _pieces.clear()
    if len(piece) <= 40:
        _pieces[piece] = got
    return got


def leaf_tokens(text: str, path: tuple[str, ...]) -> tuple[list[int], int]:
    """(buckets, how many of them are words): all words of the leaf, then its tag path and shape."""
    words: list[int] = []
    get = _pieces.get
    for piece in text.split():
        got = get(piece)
        words += _word_buckets(piece) if got is None else got
    shape = (
        f"\x01len{len(text).bit_length()}",
        f"\x01n{min(len(words), 12)}",
        f"\x01{text.isupper():d}{text[:1].isupper():d}{text[-1:] in '.:;۔':d}{'|' in text:d}",
    )
    return words + [_bucket(x) for x in shape] + _path_buckets(path), len(words)


@dataclass
class BlockModel:
    """Parameters of the labeller; a fixed size, whatever it was fitted on."""

    e: np.ndarray
    wx: list
    wh: list
    b: list
    v: np.ndarray
    u: np.ndarray
    c: np.ndarray

    @staticmethod
    def new(seed: int = 3) -> BlockModel:
        r = np.random.default_rng(seed)
        f = lambda *s, k=1.0: (r.standard_normal(s) * k).astype(np.float32)
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = 1
        return BlockModel(
            f(BUCKETS, DIM, k=0.15), [f(DIM, 4 * HIDDEN, k=DIM**-0.5) for _ in "fb"], [f(HIDDEN, 4 * HIDDEN, k=HIDDEN**-0.5) for _ in "fb"],
            [bias.copy(), bias.copy()], f(2 * HIDDEN, k=0.2), f(DIM, k=0.2), np.zeros(1, np.float32),
        )

    def params(self) -> list[np.ndarray]:
        return [self.e, *self.wx, *self.wh, *self.b, self.v, self.u, self.c]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class _Batch:
    """Documents padded to one length, time first."""

    def __init__(self, docs: list[list[tuple[list[int], int]]]) -> None:
        self.lens = np.array([len(d) for d in docs])
        self.steps, self.n = int(self.lens.max(initial=0)), len(docs)
        flat = [leaf for d in docs for leaf in d]
        sizes = np.array([len(ids) for ids, _ in flat])
        self.ids = np.fromiter(chain.from_iterable(ids for ids, _ in flat), np.int64, int(sizes.sum()))
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        words = np.array([w for _, w in flat])
        inside = np.arange(len(self.ids)) - np.repeat(self.starts, sizes) < np.repeat(words, sizes)
        self.weight = np.where(inside, np.repeat(1 / np.sqrt(np.maximum(words, 1)), sizes), 1.0).astype(np.float32)[:, None]
        self.sizes = sizes
        self.doc = np.repeat(np.arange(self.n), self.lens)
        self.pos = np.arange(len(flat)) - np.repeat(np.cumsum(self.lens) - self.lens, self.lens)
        self.mask = (np.arange(self.steps)[:, None] < self.lens[None, :]).astype(np.float32)[:, :, None]

    def inputs(self, e: np.ndarray) -> np.ndarray:
        x = np.zeros((self.steps, self.n, DIM), np.float32)
        x[self.pos, self.doc] = np.add.reduceat(e[self.ids] * self.weight, self.starts, axis=0)
        return x


def _run(x, mask, wx, wh, b, backward, keep):
    steps, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    pre = x.reshape(steps * n, -1) @ wx
    pre = pre.reshape(steps, n, -1) + b
    out = np.zeros((steps, n, HIDDEN), np.float32)
    trace = [None] * steps if keep else None
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        z = pre[t] + h @ wh
        s = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t]
        new = (f * c + i * g) * m + c * (1 - m)
        tc = np.tanh(new)
        nh = o * tc * m + h * (1 - m)
        if keep:
            trace[t] = (i, f, o, g, c, h, tc)
        c, h = new, nh
        out[t] = h
    return out, trace


def _unroll(dout, x, mask, wx, wh, trace, backward):
    steps, n, _ = x.shape
    dz_all = np.zeros((steps, n, 4 * HIDDEN), np.float32)
    dwh = np.zeros_like(wh)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in range(steps) if backward else range(steps - 1, -1, -1):
        i, f, o, g, c, h, tc = trace[t]
        m = mask[t]
        dh = dh + dout[t]
        live, rest = dh * m, dh * (1 - m)
        dnew = dc + live * o * (1 - tc * tc)
        do = live * tc
        dl = dnew * m
        dz = np.concatenate([dl * g * i * (1 - i), dl * c * f * (1 - f), do * o * (1 - o), dl * i * (1 - g * g)], axis=1)
        dz_all[t] = dz
        dwh += h.T @ dz
        dh = dz @ wh.T + rest
        dc = dl * f + dnew * (1 - m)
    flat = dz_all.reshape(steps * n, -1)
    return (flat @ wx.T).reshape(x.shape), x.reshape(steps * n, -1).T @ flat, dwh, flat.sum(0)


class LeafVectors:
    """Rows of what the network reads of a leaf: its vector times the input weights of both directions and times the
    readout. They depend on text and tag path alone, so leaves that were met before are looked up."""

    #: Leaves that are kept, and the most characters of one; longer ones seldom come again. Only speed depends on it.
    MOST, MOST_CHARS = 60_000, 100

    def __init__(self, model: BlockModel) -> None:
        self.model = model
        self.weights = np.concatenate([*model.wx, model.u[:, None]], axis=1)
        self.bias = np.concatenate([*model.b, model.c])
        self.begin()

    def begin(self) -> None:
        self.at: dict[tuple[str, tuple[str, ...]], int] = {}
        self.rows = np.zeros((4096, self.weights.shape[1]), np.float32)

    def of(self, leaves: list[tuple[str, tuple[str, ...]]]) -> np.ndarray:
        """The rows of leaves (text, tag path)."""
        if len(self.at) > self.MOST:
            self.begin()
        places = list(map(self.at.get, leaves))
        if None in places:
            fresh = list(dict.fromkeys(leaf for leaf, p in zip(leaves, places) if p is None))
            fresh.sort(key=lambda leaf: len(leaf[0]) > self.MOST_CHARS)  # those that are kept come first
            kept = sum(len(leaf[0]) <= self.MOST_CHARS for leaf in fresh)
            batch = _Batch([[leaf_tokens(x, path) for x, path in fresh]])
            first, end = len(self.at), len(self.at) + len(fresh)
            while end > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[first:end] = batch.inputs(self.model.e)[:, 0] @ self.weights + self.bias
            now = dict(zip(fresh, range(first, end)))
            places = [now[leaf] if p is None else p for leaf, p in zip(leaves, places)]
            self.at.update(zip(fresh[:kept], range(first, first + kept)))
        return self.rows[places]


def _read(pre: np.ndarray, lens: np.ndarray, wh: np.ndarray, backward: bool) -> np.ndarray:
    """States of one direction over documents sorted by falling length: at each step only the documents that reach it."""
    steps, n, _ = pre.shape
    live = np.searchsorted(-lens, -np.arange(steps), side="left")
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out = np.zeros((steps, n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        k = live[t]
        z = pre[t, :k] + h[:k] @ wh
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        c[:k] = gates[:, HIDDEN : 2 * HIDDEN] * c[:k] + gates[:, :HIDDEN] * np.tanh(z[:, 3 * HIDDEN :])
        h[:k] = gates[:, 2 * HIDDEN :] * np.tanh(c[:k])
        out[t, :k] = h[:k]
    return out


def probabilities(vectors: LeafVectors, docs: list[list[tuple[str, tuple[str, ...]]]], cells: int = 24_000) -> list[np.ndarray]:
    """For each document of leaves (text, tag path) the probability of each leaf to be site matter; documents of like length run together."""
    out: list = [np.zeros(0, np.float32)] * len(docs)
    order = sorted((k for k, d in enumerate(docs) if d), key=lambda k: -len(docs[k]))
    model, at, gates = vectors.model, 0, 4 * HIDDEN
    while at < len(order):
        part = order[at : at + max(1, min(512, cells // len(docs[order[at]])))]
        at += len(part)
        lens = np.array([len(docs[k]) for k in part])
        rows = vectors.of([leaf for k in part for leaf in docs[k]])
        doc = np.repeat(np.arange(len(part)), lens)
        pos = np.arange(len(rows)) - np.repeat(np.cumsum(lens) - lens, lens)
        pre = np.zeros((int(lens[0]), len(part), 2 * gates + 1), np.float32)
        pre[pos, doc] = rows
        hf = _read(pre[:, :, :gates], lens, model.wh[0], False)
        hb = _read(pre[:, :, gates : 2 * gates], lens, model.wh[1], True)
        p = _sigmoid(hf @ model.v[:HIDDEN] + hb @ model.v[HIDDEN:] + pre[:, :, -1])
        for j, k in enumerate(part):
            out[k] = p[: lens[j], j]
    return out


def train(docs: list[list[tuple[list[int], int]]], labels: list[list[int]], epochs: int = 5, width: int = 24, rate: float = 0.012, longest: int = 260, seed: int = 5) -> BlockModel:
    """Fit the labeller by Adam on cross-entropy; documents beyond ``longest`` leaves are cut into stretches for training."""
    pairs = []
    for d, y in zip(docs, labels):
        for at in range(0, len(d), longest):
            pairs.append((d[at : at + longest], y[at : at + longest]))
    model = BlockModel.new(seed)
    if not pairs:
        return model
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in model.params()]
    second = [np.zeros_like(p) for p in model.params()]
    step, total = 0, epochs * -(-len(pairs) // width)
    for _ in range(epochs):
        order = sorted(rng.permutation(len(pairs)), key=lambda k: len(pairs[k][0]) + rng.random() * 30)
        groups = [order[i : i + width] for i in range(0, len(order), width)]
        for g in rng.permutation(len(groups)):
            part = [pairs[k] for k in groups[g]]
            batch = _Batch([d for d, _ in part])
            x = batch.inputs(model.e)
            y = np.zeros((batch.steps, batch.n), np.float32)
            y[batch.pos, batch.doc] = np.concatenate([np.asarray(t, np.float32) for _, t in part])
            hf, tf = _run(x, batch.mask, model.wx[0], model.wh[0], model.b[0], False, True)
            hb, tb = _run(x, batch.mask, model.wx[1], model.wh[1], model.b[1], True, True)
            p = _sigmoid(hf @ model.v[:HIDDEN] + hb @ model.v[HIDDEN:] + x @ model.u + model.c)
            d = (p - y) * batch.mask[:, :, 0] / max(1.0, float(batch.mask.sum()))
            dxf, dwxf, dwhf, dbf = _unroll(d[:, :, None] * model.v[:HIDDEN], x, batch.mask, model.wx[0], model.wh[0], tf, False)
            dxb, dwxb, dwhb, dbb = _unroll(d[:, :, None] * model.v[HIDDEN:], x, batch.mask, model.wx[1], model.wh[1], tb, True)
            dx = dxf + dxb + d[:, :, None] * model.u
            de = np.zeros_like(model.e)
            by_id = np.argsort(batch.ids, kind="stable")
            rows = (np.repeat(dx[batch.pos, batch.doc], batch.sizes, axis=0) * batch.weight)[by_id]
            used, first_row = np.unique(batch.ids[by_id], return_index=True)
            de[used] = np.add.reduceat(rows, first_row, axis=0)
            flat = d.reshape(-1)
            dv = np.concatenate([hf.reshape(-1, HIDDEN).T @ flat, hb.reshape(-1, HIDDEN).T @ flat])
            grads = [de, dwxf, dwxb, dwhf, dwhb, dbf, dbb, dv, x.reshape(-1, DIM).T @ flat, np.array([flat.sum()], np.float32)]
            norm = float(np.sqrt(sum(float((q * q).sum()) for q in grads)))
            scale = min(1.0, 1.0 / max(norm, 1e-9))
            step += 1
            lr = rate * (1 - 0.9 * step / total)
            for q, p_, a, b in zip(grads, model.params(), first, second):
                q = q * scale
                a += 0.1 * (q - a)
                b += 0.01 * (q * q - b)
                p_ -= (lr * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model
