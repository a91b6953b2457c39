"""Lines that many documents share, dropped everywhere but in one: keep bitmaps from a sorted stream of line hashes.

A text is split at ``\\n``.  A line's key is the line without white space
``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased.  Keys of at least
``least_chars`` code points that ``least_docs`` documents or more hold lose all
their lines, except those in the largest id that holds the key.

One row per (document, key) with the key's 128-bit hash and its line numbers is
written, range-partitioned by (hash, id from the largest) and sorted that way.
A task streams its range: the first document of a hash is the one that keeps
its lines, later ones lose theirs once ``least_docs`` are seen.  Only the first
and the last hash of a range can go on in another range; of those the task
gives the rows of its ``least_docs`` largest ids (all smaller ones are dropped
for certain), and one small join decides them.  A key that a third of all
documents hold is thus cut into many ranges.  The result is a compressed bitmap
of kept lines per document that loses any; texts meet their bitmaps only in
:func:`apply` and :func:`digests`.

Defined results: a null or empty text is one empty line; a null id is one
document, smaller than all others; rows with equal ids are one
document (its lines are counted once and kept or dropped in all its rows),
told apart by the hash of their text; repeated rows give repeated rows; an empty
table gives an empty table; other columns are not read.  Texts are taken whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resale.llm.common import keyed, slices, written

LEAST_CHARS, LEAST_DOCS = 20, 3
#: Bytes of text split at once.
SLICE = 4 << 20
NULL_ID = -(2**63)
LINE_SCHEMA = "h1 long, h2 long, doc_id long, sig long, lines binary"


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, sig, text); ``sig`` tells the texts of one id apart."""
    rows = keyed(df, id_col, text_col)
    return rows.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.xxhash64("text").alias("sig"), "text")


def _keys(text: bytes, least_chars: int) -> dict[bytes, list[int]]:
    """Line numbers of each key that is long enough."""
    found: dict[bytes, list[int]] = {}
    for at, line in enumerate(text.split(b"\n")):
        if len(line) < least_chars:
            continue
        key = line.strip().lower()
        if len(key) >= least_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= least_chars):
            found.setdefault(key, []).append(at)
    return found


def line_hashes(df: DataFrame, least_chars: int = LEAST_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h1, h2, doc_id, sig, lines): a row per document and key."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            hashes, owner, lines = [], [], []
            for i, text in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                for key, at in _keys(text, least_chars).items():
                    hashes.append(xxhash.xxh3_128_digest(key))
                    owner.append(i)
                    lines.append(np.array(at, "<u4").tobytes())
            h = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            own = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), b.column("doc_id").take(own), b.column("sig").take(own), pa.array(lines, pa.binary())], ["h1", "h2", "doc_id", "sig", "lines"])

    return written(_rows(df, id_col, text_col).mapInArrow(step, LINE_SCHEMA), "line-hashes")


def _verdicts(lines: DataFrame, least_docs: int) -> DataFrame:
    """Rows of ``lines`` that are dropped for certain (``drop``), and those that the ends of the ranges leave open (``edge``)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.RecordBatch | None = None  # rows of the last hash that belong to its ``least_docs`` largest ids here
        closed = 0  # hashes that have ended in this range

        def out(rows: pa.RecordBatch, state: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array([state] * rows.num_rows, pa.string())], [*rows.schema.names, "state"])

        for b in batches:
            if not b.num_rows:
                continue
            if carry is not None:
                b = pa.concat_batches([carry, b.cast(carry.schema)])
            h1, h2, doc = (b.column(k).to_numpy() for k in range(3))
            begins = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            ids = np.cumsum(begins | np.r_[True, doc[1:] != doc[:-1]])
            start = np.flatnonzero(begins)
            group = np.cumsum(begins) - 1
            order = ids - ids[start][group]  # 0: the largest id of the hash
            total = np.r_[order[start[1:] - 1], order[-1]][group] + 1
            last = group == group[-1]  # this hash may go on
            edge = (group == 0) if not closed else np.zeros(len(doc), bool)  # this one may have begun in another range
            near = order < least_docs
            drop = np.where(last | edge, ~near, (order > 0) & (total >= least_docs))
            if drop.any():
                yield out(b.filter(pa.array(drop)), "drop")
            if (edge & near & ~last).any():
                yield out(b.filter(pa.array(edge & near & ~last)), "edge")
            carry = b.filter(pa.array(last & near))
            closed += len(start) - 1
        if carry is not None:
            yield out(carry, "edge")

    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc(), F.col("sig")]
    dealt = lines.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    return written(dealt.mapInArrow(step, f"{LINE_SCHEMA}, state string"), "line-verdicts")


def _resolve(found: DataFrame, least_docs: int) -> DataFrame:
    """(doc_id, sig, lines) of all dropped lines."""
    edge = found.where("state = 'edge'")  # at most two hashes a range, with at most least_docs ids each
    hashes = edge.groupBy("h1", "h2").agg(F.max("doc_id").alias("keeper"), F.count_distinct("doc_id").alias("docs"))
    settled = edge.join(hashes.where(F.col("docs") >= least_docs), ["h1", "h2"]).where("doc_id != keeper")
    cols = ["doc_id", "sig", "lines"]
    return found.where("state = 'drop'").select(cols).unionByName(settled.select(cols))


def keep_bitmaps(df: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sig, n_dropped, bitmap) of the documents that lose lines; ``bitmap`` is as :func:`kept_lines` reads it."""
    if least_docs < 2:
        raise ValueError("a key that one document holds cannot be dropped: least_docs is 2 or more")
    dropped = _resolve(_verdicts(line_hashes(df, least_chars, id_col, text_col), least_docs), least_docs)
    per_doc = dropped.groupBy("doc_id", "sig").agg(F.collect_list("lines").alias("lines"))  # of one document

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps, sizes = [], []
            for parts in b.column("lines").to_pylist():
                at = np.unique(np.frombuffer(b"".join(parts), "<u4"))
                keep = np.ones((int(at[-1]) // 8 + 1) * 8, bool)
                keep[at] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
                sizes.append(len(at))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("sig"), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary())], ["doc_id", "sig", "n_dropped", "bitmap"])

    return per_doc.mapInArrow(step, "doc_id long, sig long, n_dropped long, bitmap binary")


def kept_lines(n_lines: int, bitmap: bytes | None) -> np.ndarray:
    """Which lines stay: bits from the first line on, set for kept lines; lines beyond the bitmap stay, and all without one."""
    keep = np.ones(n_lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)
        n = min(n_lines, len(bits))
        keep[:n] = bits[:n]
    return keep


def _applied(df: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str, fields: list[tuple[str, pa.DataType, str]], derive) -> DataFrame:
    """One row per row of ``df``: its id, line counts, and what ``derive`` makes of its kept text."""
    rows, maps = _rows(df, id_col, text_col).alias("r"), bitmaps.alias("m")
    joined = rows.join(maps, (F.col("r.doc_id") == F.col("m.doc_id")) & (F.col("r.sig") == F.col("m.sig")), "left")
    joined = joined.select(F.nullif(F.col("r.doc_id"), F.lit(NULL_ID)).alias("doc_id"), "text", "bitmap")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            out: list[list] = [[], [], []]
            for text, bitmap in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("bitmap").to_pylist()):
                n = text.count(b"\n") + 1
                dropped = 0
                if bitmap is not None:
                    keep = kept_lines(n, bitmap)
                    text, dropped = b"\n".join(x for x, k in zip(text.split(b"\n"), keep.tolist()) if k), n - int(keep.sum())
                for values, v in zip(out, (n, dropped, derive(text))):
                    values.append(v)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], fields[0][1])], ["doc_id", "n_lines", "n_dropped", fields[0][0]])

    return joined.mapInArrow(step, f"doc_id long, n_lines long, n_dropped long, {fields[0][0]} {fields[0][2]}")


def apply(df: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) with the kept lines joined by ``\\n``."""
    return _applied(df, bitmaps, id_col, text_col, [("text", pa.string(), "string")], lambda t: t.decode("utf-8", "replace"))


def digests(df: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of the kept texts."""
    return _applied(df, bitmaps, id_col, text_col, [("kept_sha256", pa.string(), "string")], lambda t: hashlib.sha256(t).hexdigest())
