"""Ranked lexical search over a block index: accumulators of short lists, then document-at-a-time over long ones.

*Index.*  Terms are the maximal runs of ``0-9 A-Z a-z`` and of characters beyond
U+007F, A-Z lower-cased.  Each task cuts its documents into blocks of bounded
size and writes, per block, one row with the documents' ids and lengths and one
row per term with its posting list (ordinals in ascending id order, term
frequencies).  A term that every document holds is thus one list per block,
never one group, and writing needs no shuffle.

*Search.*  Only the lists of the queries' terms are read.  Their sizes add up to
the document frequencies; a block's lists come together in one task, which
ranks all queries over that block.  For one query, the postings of its short
lists are summed into accumulators first (term at a time).  These sums, ordered
by document, are one more list with an upper bound of its own, next to the long
lists with theirs.  Then the lists are walked document at a time, in ranges of
ordinals: lists whose upper bounds add up to no more than the worst of the best
``k`` scores so far propose no documents, and are only looked into, in order of
falling bound, for documents that can still get there.  The best ``k`` of a
block meet those of the other blocks by a window that ranks within each task
before the shuffle.  Nothing is approximated: what is skipped cannot reach the
result.

*Score* (integers; ``div`` rounds down): with N documents that have a term, L
terms in them, n the document's terms and df the documents that hold the term,
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` summed over the query's terms, with
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 10 + (90 * n * N) div L``.

Defined results: a null text has no term and is in no list; a null document id is
ranked after all others of its score; rows with equal document ids are documents of their
own; rows with one query id are one query with the terms of all of them (null is an id too); a
query without a known term, and a score of 0, give no row; empty tables give an
empty table; other columns are not read.  Texts are taken whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resale.llm.common import keyed, slices, written

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # after lower-casing: every byte of a character beyond U+007F counts
TOP = 10
#: Documents and bytes of text in a block (one longer text is a block by itself).
BLOCK_DOCS, BLOCK_BYTES = 4096, 8 << 20
#: Lists of at most this share of a block's documents are summed into accumulators.
SHORT = 0.05
#: Ordinals that one step of the document-at-a-time walk covers.
RANGE = 1024
#: Distinct query terms that are searched for at once; more go in further rounds.
MAX_TERMS = 200_000
INDEX_SCHEMA = "block long, term binary, df int, a binary, b binary"


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text, with repeats (``bytes.lower`` lower-cases A-Z only)."""
    return TERM.findall(text.lower())


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the block index.

    A row with a null term describes a block: ``a`` holds the ids (8 bytes each,
    ascending, null ids last), ``b`` the number of terms (4 bytes each), ``df`` the
    number of null ids.  The others are lists: ``a`` the ordinals (4 bytes each),
    ``b`` the term frequencies.
    """

    def block(number: int, ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        vocabulary: dict[bytes, int] = {}
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        rows, lengths, kept = [], [], []
        for i in order:
            terms = terms_of(texts[i])
            if terms:
                rows.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in terms], np.int64))
                lengths.append(len(terms))
                kept.append(ids[i])
        if not kept:
            return
        n = len(kept)
        keys = np.concatenate(rows) * n + np.repeat(np.arange(n), lengths)
        keys, tf = np.unique(keys, return_counts=True)
        begins = np.searchsorted(keys, np.arange(len(vocabulary) + 1) * n)
        cut = (begins * 4).astype(np.int32)

        def pieces(values: np.ndarray) -> pa.Array:
            data = pa.py_buffer(np.ascontiguousarray(values, "<u4").tobytes())
            return pa.Array.from_buffers(pa.binary(), len(vocabulary), [None, pa.py_buffer(cut.tobytes()), data])

        nulls = sum(x is None for x in kept)
        head = [np.array([x or 0 for x in kept], "<i8").tobytes(), np.array(lengths, "<u4").tobytes()]
        names = ["block", "term", "df", "a", "b"]
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([None], pa.binary()), pa.array([nulls], pa.int32()), pa.array(head[:1], pa.binary()), pa.array(head[1:], pa.binary())], names)
        m = len(vocabulary)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, number)), pa.array(list(vocabulary), pa.binary()), pa.array(np.diff(begins).astype(np.int32)), pieces(keys % n), pieces(tf)], names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for b in slices(batches, "text", BLOCK_BYTES // 4):
            more = [x or b"" for x in b.column("text").cast(pa.binary()).to_pylist()]
            grown = sum(map(len, more))
            if ids and (len(ids) + len(more) > BLOCK_DOCS or size + grown > BLOCK_BYTES):
                yield from block(number, ids, texts)
                number, ids, texts, size = number + 1, [], [], 0
            ids, texts, size = ids + b.column("doc_id").to_pylist(), texts + more, size + grown
        if ids:
            yield from block(number, ids, texts)

    return written(keyed(docs, id_col, text_col).mapInArrow(step, INDEX_SCHEMA), "block-index")


class Block:
    """One block's documents and the lists of the queries' terms, with every posting's part of a score."""

    def __init__(self, head: tuple, lists: dict[bytes, tuple], weights: dict[bytes, int], n_docs: int, n_terms: int):
        nulls, ids, lengths = head
        self.ids = np.frombuffer(ids, "<i8")
        self.null_from = len(self.ids) - nulls
        n = np.frombuffer(lengths, "<u4").astype(np.int64)
        top = int(n.max(initial=0))
        wide = 90 * top * n_docs < 1 << 62  # else beyond 64 bits
        m8 = 8 * (10 + (90 * n * n_docs // n_terms if wide else np.array([90 * x * n_docs // n_terms for x in n.tolist()], np.int64)))
        self.lists = {}
        for term, (ordinals, tf) in lists.items():
            if weights[term]:
                at, f = np.frombuffer(ordinals, "<u4").astype(np.int64), np.frombuffer(tf, "<u4").astype(np.int64)
                part = weights[term] * (1_000_000_000 * f // (1000 * f + m8[at]))
                self.lists[term] = (at, part, int(part.max()))

    def best(self, terms: list[bytes], top: int) -> tuple[np.ndarray, np.ndarray]:
        """Ordinals and scores of the best documents, best first, equal scores in order of the documents."""
        n = len(self.ids)
        mine = [self.lists[t] for t in terms if t in self.lists]
        limit = max(top, int(SHORT * n))
        short, long = [x for x in mine if len(x[0]) <= limit], [x for x in mine if len(x[0]) > limit]
        walked = long
        if short:
            at = np.concatenate([x[0] for x in short])
            found, where = np.unique(at, return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, where, np.concatenate([x[1] for x in short]))
            walked = [*long, (found, sums, int(sums.max()))]
        best_at, best = np.empty(0, np.int64), np.empty(0, np.int64)
        if not walked:
            return best_at, best
        walked = sorted(walked, key=lambda x: x[2])
        reach = np.cumsum([x[2] for x in walked])  # what a document gets from the lists up to this one, at most
        cuts = [np.searchsorted(x[0], np.arange(0, n + RANGE, RANGE)) for x in walked]
        floor = 0  # a later document has to score more
        for k in range(-(-n // RANGE)):
            first = int(np.searchsorted(reach, floor, "right"))  # lists before it cannot bring a document in by themselves
            if first == len(walked):
                break
            base = k * RANGE
            scores = np.zeros(min(RANGE, n - base), np.int64)
            for x, cut in zip(walked[first:], cuts[first:]):
                scores[x[0][cut[k] : cut[k + 1]] - base] += x[1][cut[k] : cut[k + 1]]
            at = np.flatnonzero(scores)
            for i in range(first - 1, -1, -1):
                at = at[scores[at] + reach[i] > floor]
                if not len(at):
                    break
                x, lo, hi = walked[i], cuts[i][k], cuts[i][k + 1]
                place = np.searchsorted(x[0][lo:hi], at + base)
                there = place < hi - lo
                there[there] = x[0][lo:hi][place[there]] == at[there] + base
                scores[at[there]] += x[1][lo:hi][place[there]]
            at = at[scores[at] > floor]
            if len(at):
                best_at, best = np.r_[best_at, at + base], np.r_[best, scores[at]]
                order = np.argsort(-best, kind="stable")[:top]
                best_at, best = best_at[order], best[order]
                if len(best) == top:
                    floor = int(best[-1])
        return best_at, best


def _query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, item, term): distinct terms of each query id; ``item`` tells null from 0."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = [sorted(set(terms_of(x or b""))) for x in b.column("text").cast(pa.binary()).to_pylist()]
            own = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(own), pa.array([t for x in found for t in x], pa.binary())], ["item_id", "term"])

    return keyed(queries, id_col, text_col).mapInArrow(step, "item_id long, term binary").distinct()


def search(index: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "item_id", text_col: str = "text", max_terms: int = MAX_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every query."""
    asked = written(_query_terms(queries, id_col, text_col), "query-terms")
    spark = index.sparkSession

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = [np.frombuffer(x, "<u4") for x in b.column("b").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, lengths))], pa.int64()), pa.array([sum(int(x.sum(dtype=np.int64)) for x in lengths)], pa.int64())], ["docs", "terms"])

    total = index.where("term is null").select("b").mapInArrow(sizes, "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    n_docs, n_terms = total.docs or 0, total.terms or 0
    pairs = asked.count()
    rounds = max(1, -(-pairs // max_terms))
    found = [_search_round(index, asked.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r) if rounds > 1 else asked, n_docs, n_terms, top) for r in range(rounds)] if n_docs and pairs else []
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = found[0]
    for f in found[1:]:
        best = best.unionByName(f)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_round(index: DataFrame, asked: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """The best documents of each block for the queries of one round (its terms are bounded by ``max_terms``, on average)."""
    spark = index.sparkSession
    terms = asked.select("term").distinct()
    lists = index.where("term is not null").join(F.broadcast(terms), "term", "left_semi")
    df = {bytes(r.term): r.df for r in lists.groupBy("term").agg(F.sum("df").alias("df")).collect()}  # a row per query term
    weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    items: dict[int | None, list[bytes]] = {}
    for r in asked.collect():
        if weights.get(bytes(r.term)):
            items.setdefault(r.item_id, []).append(bytes(r.term))
    shared = spark.sparkContext.broadcast((weights, sorted(items.items(), key=lambda x: (x[0] is None, x[0] or 0))))

    def rank(head, got: dict) -> pa.RecordBatch:
        weights, items = shared.value
        block = Block(head, got, weights, n_docs, n_terms)
        item, doc, score = [], [], []
        for number, wanted in items:
            at, s = block.best(wanted, top)
            item += [number] * len(at)
            doc += [int(block.ids[i]) if i < block.null_from else None for i in at.tolist()]
            score += s.tolist()
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, got = None, None, {}
        for b in batches:
            for number, term, df, x, y in zip(*(b.column(c).to_pylist() for c in ("block", "term", "df", "a", "b"))):
                if number != key:
                    if got:
                        yield rank(head, got)
                    key, got = number, {}
                if term is None:
                    head = (df, x, y)
                else:
                    got[term] = (x, y)
        if got:
            yield rank(head, got)

    rows = index.where("term is null").unionByName(lists.select(*index.columns))
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("term").asc_nulls_first())
    return written(dealt.mapInArrow(step, "item_id long, doc_id long, score long"), "block-best")
