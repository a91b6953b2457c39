"""Language identification: nearest centroid over normalised TF-IDF vectors of hashed letter n-grams.

Texts are lower-cased; letters stay, everything else becomes one blank.  All
n-grams of 1 to 3 characters of the whole text are hashed into ``DIMS``
counts, weighted (log of the count, IDF) and normalised.  Each language has
several centroids (spherical k-means over its training vectors); a text gets
the language of the centroid with the largest cosine.  It is rejected when its
cosine to that centroid is below nearly all that held-out training texts of that
language and of about its length show: short texts score low, so there is a bound
per range of lengths, learned from whole texts and from first parts of texts.

The classifier is fitted on a bounded sample: per language the
``per_language`` ids with the smallest hash, ``MAX_ROWS`` in all languages
together; of an id with several texts or languages the smallest is taken, and rows
without an id are not learned from.  Two
vectors of 16 KB per id (not the texts) go to the driver, so at most 128 MB.
Languages beyond ``max_languages`` are an error.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and is rejected; repeated rows give repeated rows; ties go to the language that
sorts first; without training rows every text is ``und``; an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resale.llm.common import hashed_sample, keyed, slices, strings, trimmed

DIMS = 4096
ORDERS = (1, 2, 3)
PER_LANGUAGE = 400
MAX_LANGUAGES = 200
#: Training rows of all languages together.
MAX_ROWS = 4000
CENTROIDS = 3
#: A text is rejected below MARGIN times the cosine that this share of held-out training texts stays under.
LOW, MARGIN = 0.01, 0.85
FOLDS = 5
#: First parts of the training texts, in characters, and the ranges of lengths (n-grams per order) with a bound of their own.
PARTS = (16, 64, 256)
EDGES = np.array([32, 128, 512])
#: Fewest held-out cosines that make a bound.
LEAST_ROWS = 100
UNKNOWN = "und"
#: Characters counted at once of a very long text.
BLOCK = 1 << 20
#: Bytes of text held as strings, and texts whose vectors are made, at once.
SLICE, TOGETHER = 1 << 20, 128


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it has no letter."""
    out = np.zeros(DIMS, np.int64)
    low = text.lower()
    carry = np.array([32], np.uint32)  # a blank before the text
    seen = False
    for at in range(0, len(low), BLOCK):
        c = np.frombuffer(low[at : at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        keep = _letters()[c]
        seen = seen or bool(keep.any())
        c = np.where(keep, c, 32)
        c = np.r_[carry, c]
        c = np.r_[c[:1], c[1:][(c[1:] != 32) | (c[:-1] != 32)]]
        if at + BLOCK >= len(low) and c[-1] != 32:
            c = np.r_[c, np.uint32(32)]
        x = c.astype(np.uint64)
        h = np.zeros(len(x), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            h = (h[: len(x) - n + 1] if n > 1 else h) * np.uint64(1000003) + x[n - 1 :]
            if n in ORDERS and len(h):
                fresh = h if at == 0 else h[max(0, len(carry) - n + 1) :]
                out += np.bincount(((fresh * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) >> np.uint64(52)).astype(np.int64), minlength=DIMS)
        carry = c[-(max(ORDERS) - 1) :]
    return out if seen else None


def lengths(rows: np.ndarray) -> np.ndarray:
    """Range of lengths of each row of counts."""
    return np.searchsorted(EDGES, rows.sum(axis=1) // len(ORDERS), "right")


@dataclass
class Model:
    """Learned IDF, centroids (one row each), their languages, and the least cosine each language accepts per range of lengths."""

    idf: np.ndarray
    centroids: np.ndarray
    owners: np.ndarray
    languages: list[str]
    least: np.ndarray

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        v = np.log1p(rows).astype(np.float32) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        cos = self.vectors(rows) @ self.centroids.T
        best = np.array([cos[:, self.owners == k].max(axis=1) for k in range(len(self.languages))]).T
        pick = best.argmax(axis=1)
        score = np.clip(best[np.arange(len(pick)), pick], 0, 1)
        return [self.languages[k] for k in pick], score, score < self.least[pick, lengths(rows)]


def _k_means(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from farthest-point seeds."""
    seeds = [v.mean(axis=0)]
    for _ in range(min(k, len(v)) - 1):
        seeds.append(v[int(np.max(v @ np.array(seeds).T, axis=1).argmin())])
    c = np.array(seeds)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = (v @ c.T).argmax(axis=1)
        c = np.array([v[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _least(v: np.ndarray, own: np.ndarray, tests: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Bounds (language x range of lengths) from cosines to centroids that were learned without the text.

    ``tests`` holds (training row, vector, range of lengths) of the texts and of
    their first parts.  A range with too few of a language counts all languages, then
    all shorter texts too; what cannot be told is 0 (nothing rejected).
    """
    cos = [np.full(len(row), np.nan) for row, _, _ in tests]
    for k in range(n):
        mine = np.flatnonzero(own == k)
        for fold in range(min(FOLDS, len(mine)) if len(mine) > 1 else 0):
            out = mine[fold::FOLDS]
            g = _k_means(v[np.setdiff1d(mine, out)], CENTROIDS)
            for c, (row, w, _) in zip(cos, tests):
                at = np.isin(row, out)
                c[at] = (w[at] @ g.T).max(axis=1)
    c, lang, size = np.concatenate(cos), np.concatenate([own[row] for row, _, _ in tests]), np.concatenate([s for _, _, s in tests])
    known = ~np.isnan(c)

    def bound(k: int, j: int) -> float:
        for some in ((lang == k) & (size == j), size == j, size <= j):
            if (some & known).sum() >= LEAST_ROWS:
                return MARGIN * float(np.quantile(c[some & known], LOW))
        return 0.0

    return np.array([[bound(k, j) for j in range(len(EDGES) + 1)] for k in range(n)])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Model | None:
    """Fit on a bounded sample of the labelled rows of ``docs``; None if there are none."""
    rows = keyed(docs, id_col, text_col)
    labelled = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang")).where("doc_id is not null and lang is not null")
    n_languages = labelled.select("lang").distinct().limit(max_languages + 1).count()
    if n_languages > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    per_language = min(per_language, max(MAX_ROWS // max(n_languages, 1), 1))
    picked: dict[int, str] = {}
    for r in sorted(hashed_sample(labelled, per_language, "lang").collect(), key=lambda r: (r.doc_id, r.lang)):  # at most MAX_ROWS
        picked.setdefault(r.doc_id, r.lang)
    if not picked:
        return None

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            got = [(i, c, counts(t[: PARTS[i % len(PARTS)]])) for i, t in zip(b.column("doc_id").to_pylist(), strings(b.column("text"))) if (c := counts(t)) is not None]
            packed = [pa.array([None if c is None else c.astype("<u4").tobytes() for c in cs], pa.binary()) for cs in ([c for _, c, _ in got], [c for _, _, c in got])]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in got], pa.int64()), *packed], ["doc_id", "counts", "part"])

    ids = docs.sparkSession.createDataFrame([(i,) for i in picked], "doc_id long")  # bounded by the sample
    texts = rows.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    sample = texts.mapInArrow(step, "doc_id long, counts binary, part binary")
    found = sorted((picked[r.doc_id], r.doc_id, bytes(r.counts), bytes(r.part or b"")) for r in sample.collect())
    if not found:
        return None
    x = np.array([np.frombuffer(c, "<u4") for _, _, c, _ in found])
    cut = np.array([at for at, f in enumerate(found) if f[3]], np.int64)
    parts = np.array([np.frombuffer(found[at][3], "<u4") for at in cut]).reshape(-1, DIMS)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    languages = sorted({f[0] for f in found})
    own = np.array([languages.index(f[0]) for f in found])
    plain = Model(idf, np.empty(0), np.empty(0), [], np.empty(0))
    v = plain.vectors(x)
    groups = [_k_means(v[own == k], CENTROIDS) for k in range(len(languages))]
    least = _least(v, own, [(np.arange(len(x)), v, lengths(x)), (cut, plain.vectors(parts), lengths(parts))], len(languages))
    return Model(idf, np.concatenate(groups), np.repeat(np.arange(len(groups)), [len(g) for g in groups]), languages, least)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row."""
    return keyed(docs, id_col, text_col).mapInArrow(_predictor(model, "text", ["doc_id"]), "doc_id long, lang_pred string, score double, rejected boolean")


def keep_accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns."""
    run = _predictor(model, text_col, docs.columns)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(batches):
            yield b.filter(pa.compute.invert(b.column(b.num_columns - 1))).select(range(b.num_columns - 3))

    return docs.mapInArrow(step, docs.schema)


def _predictor(model: Model | None, text: str, keep: list[str]):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, SLICE):
            texts = strings(b.column(text))
            lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            for at in range(0, len(texts) if model else 0, TOGETHER):
                found = [(at + i, c) for i, t in enumerate(texts[at : at + TOGETHER]) if (c := counts(t)) is not None]
                if found:
                    part = [i for i, _ in found]
                    names, score[part], rejected[part] = model.predict(np.array([c for _, c in found]))
                    for i, name in zip(part, names):
                        lang[i] = name
            cols = [b.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lang), pa.array(score), pa.array(rejected)], [*keep, "lang_pred", "score", "rejected"])

    return trimmed(step)
