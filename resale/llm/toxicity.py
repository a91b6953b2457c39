"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word (a run of letters, lower-cased) enters as the sum of the vectors of the
word itself and of its character inputs (first 3, 4 and 5 letters, last 3).
Every window of ``WINDOW`` words, ``STRIDE`` apart so that windows overlap, is
scored: two GRUs read it forwards and backwards, attention pools their states
into one logit.  A text's logit is the largest of its windows; training goes
through that window (multiple-instance learning), starting from vectors that
carry the inputs' log odds.

Training uses a bounded sample of labelled rows: per class those with the
smallest hash of their id, at most ``max_rows`` and ``max_chars`` characters
in all, whole texts only: if they are longer together, the longest of them are
left out, but never the last one of a class.  Inputs seen in fewer than ``MIN_DOCS`` of them, and
inputs beyond ``MAX_INPUTS``, have no vector.

Defined results: a null text, or one without letters, is scored as one empty
window; repeated rows give repeated rows; several labels of one id count each;
without rows of both classes every score is 0; an empty table gives an empty
table; other columns are not read.  Very long texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resale.llm.common import hashed_sample, keyed, slices, splitmix, strings
from resale.llm.language import _letters

WINDOW, STRIDE = 32, 16
HIDDEN, DIMS = 8, 8
PREFIXES, SUFFIX = (3, 4, 5), 3
INPUTS = 1 + len(PREFIXES) + 1
MIN_DOCS, MAX_INPUTS = 4, 20_000
MAX_ROWS, MAX_CHARS = {1: 400, 0: 800}, 24_000_000
EPOCHS, STEPS, BATCH, RATE = 4, 40, 128, 0.02
SLOTS = 1 << 20
#: Windows that go through the network together.
TOGETHER = 4096


_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for b in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        row = np.full(size, b, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


class InputHash:
    """Hashes of any ranges of one array modulo 2**64; for inputs of the network, which need no more than rare collisions."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(20, (len(data) - 1).bit_length())
        power, self.inverse = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def of(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        own = (self.sums[ends] - self.sums[begins]) * self.inverse[begins]
        return splitmix(own + (ends - begins).astype(np.uint64) * _STEP)


def inputs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the inputs of every word of all texts (words x INPUTS, 0 where a word is too short), and the first word of each text."""
    low = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in low], np.int64)
    c = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(sizes + 1) - sizes - 1
    letter = np.r_[False, _letters()[c], False]
    begins = np.flatnonzero(letter[1:] & ~letter[:-1])
    ends = np.flatnonzero(letter[:-1] & ~letter[1:])
    h = InputHash(c)
    size = ends - begins
    out = np.zeros((len(begins), INPUTS), np.uint64)
    out[:, 0] = h.of(begins, ends)
    for k, n in enumerate(PREFIXES, 1):
        long = size >= n
        out[long, k] = splitmix(h.of(begins[long], begins[long] + n) + np.uint64(k))
    long = size >= SUFFIX
    out[long, INPUTS - 1] = splitmix(h.of(ends[long] - SUFFIX, ends[long]) + np.uint64(INPUTS))
    return out, np.r_[np.searchsorted(begins, starts), len(begins)]


class Lookup:
    """Row numbers of known hashes: one slot each, the earlier of two keys that share a slot wins."""

    def __init__(self, keys: np.ndarray):
        slot = (keys >> np.uint64(44)).astype(np.int64)
        self.keys, self.rows = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)
        self.keys[slot[::-1]] = keys[::-1]
        self.rows[slot[::-1]] = np.arange(len(keys), 0, -1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> np.uint64(44)).astype(np.int64)
        return np.where(self.keys[slot] == hashes, self.rows[slot], 0)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, number of words) of all overlapping windows; a text without words has one empty window."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE))
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, first[text] + nth * STRIDE, np.minimum(WINDOW, n[text] - nth * STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Parameters: input vectors, two GRUs (input, state and bias matrices), attention and output."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, rows: int, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        p = {"E": rng.normal(0, 0.05, (rows, DIMS)), "v": rng.normal(0, 0.3, 2 * HIDDEN), "w": rng.normal(0, 0.3, 2 * HIDDEN), "o": np.zeros(1)}
        for d in "fb":
            p[f"W{d}"] = rng.normal(0, 0.4, (DIMS, 3 * HIDDEN))
            p[f"U{d}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
            p[f"b{d}"] = np.zeros(3 * HIDDEN)
        p["E"][0] = 0
        return cls({k: x.astype(np.float32) for k, x in p.items()})

    def _read(self, g: np.ndarray, mask: np.ndarray, d: str, keep: list | None):
        """States (windows x words x HIDDEN) of one direction; ``g`` holds the input part of the gates."""
        u, n = self.p[f"U{d}"], HIDDEN
        h = np.zeros((len(g), n), np.float32)
        out = np.empty((*g.shape[:2], n), np.float32)
        for t in range(g.shape[1]) if d == "f" else range(g.shape[1] - 1, -1, -1):
            zr = _sigmoid(g[:, t, : 2 * n] + h @ u[:, : 2 * n])
            z, r = zr[:, :n] * mask[:, t, None], zr[:, n:]
            c = np.tanh(g[:, t, 2 * n :] + (r * h) @ u[:, 2 * n :])
            if keep is not None:
                keep.append((t, h, zr, c))
            h = h + z * (c - h)
            out[:, t] = h
        return out

    def gates(self) -> dict[str, np.ndarray]:
        """Input vectors times the gate matrices, so that scoring only looks rows up."""
        return {d: self.p["E"] @ self.p[f"W{d}"] for d in "fb"}

    def pool(self, h: np.ndarray, mask: np.ndarray):
        e = np.where(mask, h @ self.p["v"], -1e9)
        a = np.exp(e - e.max(axis=1, keepdims=True)) * mask
        a = a / np.maximum(a.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,bth->bh", a, h)
        return a, pooled, pooled @ self.p["w"] + self.p["o"][0]

    def logits(self, ids: np.ndarray, at: np.ndarray, size: np.ndarray, tables: dict[str, np.ndarray]) -> np.ndarray:
        """Logits of windows over the words' input rows ``ids``."""
        out = np.empty(len(at), np.float32)
        words = {d: sum(tables[d][ids[:, j]] for j in range(INPUTS)) + self.p[f"b{d}"] for d in "fb"}
        empty = np.zeros((1, 3 * HIDDEN), np.float32)
        words = {d: np.concatenate([x, empty]).astype(np.float32) for d, x in words.items()}
        for s in range(0, len(at), TOGETHER):
            b = slice(s, s + TOGETHER)
            mask = np.arange(WINDOW) < size[b, None]
            pos = np.where(mask, at[b, None] + np.arange(WINDOW), len(ids))
            h = np.concatenate([self._read(words[d][pos], mask, d, None) for d in "fb"], axis=2)
            out[b] = self.pool(h, mask)[2]
        return out

    def gradients(self, x_ids: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss of windows (x_ids: windows x words x INPUTS) and its gradients."""
        p, n = self.p, HIDDEN
        x = p["E"][x_ids].sum(axis=2)
        kept: dict[str, list] = {"f": [], "b": []}
        h = np.concatenate([self._read(x @ p[f"W{d}"] + p[f"b{d}"], mask, d, kept[d]) for d in "fb"], axis=2)
        a, pooled, logit = self.pool(h, mask)
        s = _sigmoid(logit)
        loss = float(-np.mean(y * np.log(s + 1e-9) + (1 - y) * np.log(1 - s + 1e-9)))
        dl = (s - y) / len(y)
        g = {"w": pooled.T @ dl, "o": np.array([dl.sum()])}
        dp = dl[:, None] * p["w"]
        da = np.einsum("bth,bh->bt", h, dp)
        de = a * (da - (a * da).sum(axis=1, keepdims=True))
        g["v"] = np.einsum("bt,bth->h", de, h)
        dh = a[:, :, None] * dp[:, None] + de[:, :, None] * p["v"]
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            u, w = p[f"U{d}"], p[f"W{d}"]
            own = dh[:, :, k * n : (k + 1) * n]
            du, dw, db = np.zeros_like(u), np.zeros_like(w), np.zeros(3 * n, np.float32)
            back = np.zeros((len(y), n), np.float32)
            for t, before, zr, c in reversed(kept[d]):
                dhn = own[:, t] + back
                m = mask[:, t, None]
                z, r = zr[:, :n] * m, zr[:, n:]
                dc = dhn * z * (1 - c * c)
                drh = dc @ u[:, 2 * n :].T
                dzr = np.concatenate([dhn * (c - before) * m, drh * before], axis=1) * zr * (1 - zr)
                gate = np.concatenate([dzr, dc], axis=1)
                du[:, : 2 * n] += before.T @ dzr
                du[:, 2 * n :] += (r * before).T @ dc
                dw += x[:, t].T @ gate
                db += gate.sum(axis=0)
                dx[:, t] += gate @ w.T
                back = dhn * (1 - z) + drh * r + dzr @ u[:, : 2 * n].T
            g[f"U{d}"], g[f"W{d}"], g[f"b{d}"] = du, dw, db
        dx *= mask[:, :, None]
        ge = np.zeros_like(p["E"])
        np.add.at(ge, x_ids.reshape(-1), np.repeat(dx, INPUTS, axis=1).reshape(-1, DIMS))
        ge[0] = 0
        g["E"] = ge
        return loss, g


@dataclass
class Model:
    """A trained network, the inputs it knows, and the logit at which a text is called toxic."""

    network: Network
    keys: np.ndarray
    threshold: float

    def scorer(self):
        lookup, tables = Lookup(self.keys), self.network.gates()

        def score(texts: list[str]) -> np.ndarray:
            hashes, first = inputs(texts)
            text, at, size = windows(first)
            logit = self.network.logits(lookup(hashes), at, size, tables)
            best = np.maximum.reduceat(logit, np.flatnonzero(np.r_[True, text[1:] != text[:-1]])) if len(text) else logit
            return _sigmoid((best - self.threshold).astype(np.float64))

        return score


def train(texts: list[str], labels: np.ndarray) -> Model | None:
    """Train on whole texts; None unless both classes are there."""
    y = np.asarray(labels)
    if not (y == 1).any() or not (y == 0).any():
        return None
    hashes, first = inputs(texts)
    doc = np.repeat(np.arange(len(y)), np.diff(first))
    seen: dict[int, np.ndarray] = {}
    pairs = np.unique(np.column_stack([np.repeat(doc, INPUTS).astype(np.uint64), hashes.reshape(-1)]), axis=0)
    pairs = pairs[pairs[:, 1] != 0]
    keys, where = np.unique(pairs[:, 1], return_inverse=True)
    toxic = y[pairs[:, 0].astype(np.int64)] == 1
    seen[1], seen[0] = (np.bincount(where, toxic == bool(k), len(keys)) for k in (1, 0))
    rate = {k: (seen[k] + 0.5) / ((y == k).sum() + 1) for k in (0, 1)}
    odds = np.log(rate[1] / rate[0])
    common = np.flatnonzero(seen[0] + seen[1] >= MIN_DOCS)
    common = common[np.lexsort((keys[common], -np.maximum(rate[0], rate[1])[common], -np.abs(odds[common]).round(1)))][:MAX_INPUTS]
    keys, odds = keys[common], odds[common]
    net = Network.new(len(keys) + 1)
    net.p["E"][1:, 0] = np.clip(odds, -2, 4) / 2
    ids = Lookup(keys)(hashes)
    text, at, size = windows(first)
    starts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    rng = np.random.default_rng(7)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    clock = 0
    # before the first epoch, a window's mean log odds stand in for the network
    lead = np.r_[0, np.cumsum(np.maximum(net.p["E"][ids, 0], 0).max(axis=1) > 1.0)]
    logit = (lead[at + size] - lead[at]).astype(np.float32)
    for _ in range(EPOCHS):
        best = np.array([s + int(np.argmax(logit[s:e])) for s, e in zip(starts, np.r_[starts[1:], len(text)])])
        pos, hard = best[y == 1], best[y == 0]
        other = np.flatnonzero(y[text] == 0)
        for _ in range(STEPS):
            pick = np.concatenate([rng.choice(pos, BATCH // 2), rng.choice(hard, BATCH // 4), rng.choice(other, BATCH // 4)])
            mask = np.arange(WINDOW) < size[pick, None]
            rows = np.where(mask, at[pick, None] + np.arange(WINDOW), 0)
            x = np.where(mask[:, :, None], ids[np.minimum(rows, len(ids) - 1)], 0)
            _, g = net.gradients(x, mask, y[text[pick]].astype(np.float32))
            clock += 1
            for k, (m, v) in moment.items():
                m += 0.1 * (g[k] - m)
                v += 0.01 * (g[k] ** 2 - v)
                net.p[k] -= (RATE * (m / (1 - 0.9**clock)) / (np.sqrt(v / (1 - 0.99**clock)) + 1e-6)).astype(np.float32)
        logit = net.logits(ids, at, size, net.gates())
    top = np.maximum.reduceat(logit, starts)
    # the cut with the best balanced accuracy in the widest gap, nearer to the toxic side of the gap
    order = np.sort(top)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    gaps = [(float(weight[(top > lo) == (y == 1)].sum()), float(hi - lo), float(lo + 0.75 * (hi - lo))) for lo, hi in zip(order, order[1:])]
    return Model(net, keys, max(gaps)[2])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: dict[int, int] = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model | None:
    """Train on a bounded sample of the labelled rows; ``labels`` has the id column and a 0/1 label."""
    rows = keyed(docs, id_col, text_col)
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").distinct()
    chosen = hashed_sample(marked, max_rows, "label").collect()  # bounded by max_rows
    if not chosen:
        return None
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(r.doc_id, r.label) for r in chosen], "doc_id long, label int"))
    mine = rows.join(wanted, "doc_id").select("doc_id", "label", "text", F.length("text").alias("size"))
    # whole texts from the shortest on while they fit, so that one long text costs no other
    by = Window.partitionBy("label").orderBy("size", F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    fits = mine.select("*", F.sum("size").over(upto).alias("sum"), F.row_number().over(by).alias("nth")).where((F.col("sum") <= max_chars // 2) | (F.col("nth") == 1))
    got = sorted((r.label, r.doc_id, r.text) for r in fits.select("doc_id", "label", "text").collect())  # bounded by max_chars, or one text per class
    return train([t for _, _, t in got], np.array([k for k, _, _ in got])) if got else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) per row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = model.scorer() if model else lambda texts: np.zeros(len(texts))
        for b in slices(batches, "text", 1 << 20):
            s = run(strings(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return keyed(docs, id_col, text_col).mapInArrow(step, "doc_id long, score double, predicted int")
