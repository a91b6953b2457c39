"""Token-id files with a minimal perfect hash index over their document keys.

Texts are range-partitioned and sorted by key; each partition writes one
*shard*: a header, the raw ids of its documents one after the other (the end
id included), and a footer with the keys and lengths.  The *index* is split
into buckets by a hash of the key.  A bucket holds a minimal perfect hash
(levels of bit arrays, every word with the number of bits before it; a key sits
at the first level where it collides with nobody, its slot is the rank of its
bit) and one slot per key: fingerprint, shard, row, offset, length.  A lookup is a
bucket hash, a handful of bit tests and one slot read, whatever the number of
documents; the stored fingerprint tells foreign keys apart.  :func:`get` reads just
these bytes and the payload, never a bucket or a footer as a whole.

Files are written under a private name and moved into place, so a repeated
task leaves the same file.  Paths may lie in any store pyarrow can open.

Defined results: null text is empty (the end id alone); a null key is a key of
its own, first in order; rows with the same key lie next to each other in the
files, each with its own ids, and the index slot of (key, k) gives the k-th
shard that holds the key and how many of its rows lie there; an empty table
writes no shard.  Other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from resale.llm.chunks import ChunkEncoder
from resale.llm.common import keyed, slices, splitmix, strings, written

MAGIC = b"IDSHARD1"
INDEX_MAGIC = b"IDINDEX2"
#: Split pattern of the library's byte-level pre-tokenizer (fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text encoded at once.
SLICE = 4 << 20
#: Chunks in a generation of the encoder's cache (about 150 bytes each).
CACHED_CHUNKS = 250_000
KEYS_PER_BUCKET = 100_000
GAMMA = 2.0
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n_tokens", "<u8"), ("row", "<u8"), ("copies", "<u4"), ("parts", "<u4")])
#: A word of a level and the number of set bits before it in all levels.
WORD = np.dtype([("bits", "<u8"), ("before", "<u4")])
RUN_SCHEMA = "doc_id long, shard long, row long, offset long, n_tokens long, copies long, run_tokens long"


class IdEncoder:
    """A ``tokenizers`` tokenizer giving the id bytes of whole texts in the width of its vocabulary.

    A plain byte-level BPE (no normalizer, no prefix blank) goes through the
    chunk cache; any other tokenizer encodes every text by itself.  As in the
    library, the file's added tokens are found first: a text is cut at them, the
    longest of those that start at one place wins, and each gives its own id.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        narrow = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype = np.dtype("<u2") if narrow else np.dtype("<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        plain = plain and model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        added = [a for a in spec.get("added_tokens") or [] if a["content"]]
        plain = plain and not any(a.get(k) for a in added for k in ("lstrip", "rstrip", "single_word"))
        self.added = {a["content"]: np.array([a["id"]], self.dtype).tobytes() for a in added}
        self.cut = re.compile("(" + "|".join(re.escape(a) for a in sorted(self.added, key=len, reverse=True)) + ")")
        self.chunks = ChunkEncoder(self.tokenizer.model, BYTE_LEVEL_PATTERN, "H" if narrow else "I", CACHED_CHUNKS, newline_alone=True) if plain else None

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.chunks:
            with_added = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
            if not with_added:
                return self.chunks.encode(texts)
            parts = [[t] for t in texts]
            for i in with_added:
                parts[i] = self.cut.split(texts[i])
            ids = iter(self.chunks.encode([x for p in parts for x in p[::2]]))
            return [b"".join(self.added[x] if k % 2 else next(ids) for k, x in enumerate(p)) for p in parts]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]


@lru_cache(maxsize=2)
def encoder(path: str) -> IdEncoder:
    return IdEncoder(path)


def _put(uri: str, name: str, write) -> None:
    """Write a file under a private name, then move it into place; a failed attempt takes its file away."""
    files, base = pafs.FileSystem.from_uri(uri)
    files.create_dir(base, recursive=True)
    tmp = f"{base}/.{name}-{uuid.uuid4().hex}"
    try:
        with files.open_output_stream(tmp) as out:
            write(out)
    except BaseException:
        files.delete_file(tmp)
        raise
    files.move(tmp, f"{base}/{name}")


def _shard_name(shard: int) -> str:
    return f"shard-{shard:07d}.bin"


def write_shards(df: DataFrame, uri: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write every text's ids in ascending key order; returns one row per (key, shard), kept as a table beside the shards."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, number = encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        keys: list[np.ndarray] = []
        nulls: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def body(out) -> None:
            out.write(MAGIC + struct.pack("<I", width))
            for b in slices(batches, "text", SLICE):
                ids = [x + end for x in enc.encode(strings(b.column("text")))]
                out.write(b"".join(ids))
                k = b.column("doc_id")
                keys.append(k.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                nulls.append(k.is_null().to_numpy(zero_copy_only=False).astype("u1"))
                sizes.append(np.fromiter((len(x) // width for x in ids), "<i8", len(ids)))
            n = sum(map(len, keys))
            for part, kind in ((keys, "<i8"), (nulls, "u1"), (sizes, "<i8")):
                out.write(np.concatenate([*part, np.empty(0, kind)]).astype(kind).tobytes())
            out.write(struct.pack("<Q", n) + MAGIC)

        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        rest = batches
        batches = (b for part in ([first], rest) for b in part)
        _put(f"{uri}/shards", _shard_name(number), body)
        key, null, size = np.concatenate(keys), np.concatenate(nulls), np.concatenate(sizes)
        begins = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (null[1:] != null[:-1])])
        ends = np.cumsum(size)
        copies = np.diff(np.r_[begins, len(key)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key[begins], mask=null[begins].astype(bool)), pa.array(np.full(len(begins), number)), pa.array(begins), pa.array((ends - size)[begins]),
                pa.array(size[begins]), pa.array(copies), pa.array(np.add.reduceat(size, begins)),
            ],
            ["doc_id", "shard", "row", "offset", "n_tokens", "copies", "run_tokens"],
        )

    rows = keyed(df, id_col, text_col)
    order = F.xxhash64("text")  # deals rows of one key over several shards
    dealt = rows.repartitionByRange("doc_id", order).sortWithinPartitions("doc_id", order)
    return written(dealt.mapInArrow(shard, RUN_SCHEMA), "token-runs")


def _key_hash(doc_id: np.ndarray, null: np.ndarray, part: np.ndarray) -> np.ndarray:
    """64-bit keys; one to one over the non-null keys of part 0."""
    extra = splitmix(part.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64)) - splitmix(np.zeros(1, np.uint64))
    return splitmix(doc_id.astype(np.int64).view(np.uint64) ^ extra)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (splitmix(keys ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of (size, bits, rank of each word)."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, at = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(at + np.cumsum(ones) - ones)
            at += int(ones.sum())
        self.size = at

    @staticmethod
    def _at(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        step = np.array([level], np.uint64) * np.uint64(0xA24BAED4963EE407)
        return splitmix(keys + step) % np.uint64(bits)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            bits = 64 * max(1, int(np.ceil(GAMMA * len(left) / 64)))
            at = cls._at(left, len(levels), bits)
            alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for a key that no level holds."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, words in enumerate(self.levels):
            at = self._at(keys[left], level, 64 * len(words)).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.ranks[level][word] + below)[hit]
            left = left[~hit]
        return out


def build_index(runs: DataFrame, uri: str, n_buckets: int) -> DataFrame:
    """Write the bucket files of the index; returns (bucket, n_keys)."""
    by_key = Window.partitionBy("doc_id")
    rows = runs.select(
        _bucket(n_buckets).alias("bucket"), "doc_id", "shard", "row", "offset", "n_tokens", "copies",
        (F.col("shard") - F.min("shard").over(by_key)).alias("part"), F.count(F.lit(1)).over(by_key).alias("parts"),
    )

    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["bucket"].iloc[0])
        null = pdf["doc_id"].isna().to_numpy()
        keys = _key_hash(pdf["doc_id"].fillna(0).to_numpy(np.int64), null, pdf["part"].to_numpy())
        mph = PerfectHash.build(keys)
        slots = np.zeros(len(keys), SLOT)
        at = mph.slots(keys)
        slots["fingerprint"][at] = _fingerprint(keys)
        for name in ("shard", "row", "offset", "n_tokens", "copies", "parts"):
            slots[name][at] = pdf[name].to_numpy()

        def body(out) -> None:
            out.write(INDEX_MAGIC + struct.pack("<II", len(slots), len(mph.levels)))
            out.write(struct.pack(f"<{len(mph.levels)}I", *map(len, mph.levels)))
            for words, before in zip(mph.levels, mph.ranks):
                level = np.zeros(len(words), WORD)
                level["bits"], level["before"] = words, before
                out.write(level.tobytes())
            out.write(slots.tobytes())

        _put(f"{uri}/index-{n_buckets}", f"bucket-{number:07d}.idx", body)
        return pd.DataFrame({"bucket": [number], "n_keys": [len(keys)]})

    return written(rows.groupBy("bucket").applyInPandas(bucket, "bucket long, n_keys long"), "token-index")


def _bucket(n_buckets: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(n_buckets))


class IndexBucket:
    """One bucket file of the index, read whole (its size is bounded by KEYS_PER_BUCKET keys on average)."""

    def __init__(self, data: bytes):
        n, levels = struct.unpack_from("<II", data, 8)
        sizes = struct.unpack_from(f"<{levels}I", data, 16)
        at, words = 16 + 4 * levels, []
        for m in sizes:
            words.append(np.frombuffer(data, WORD, m, at)["bits"])
            at += WORD.itemsize * m
        self.mph, self.slots = PerfectHash(words), np.frombuffer(data, SLOT, n, at)

    def lookup(self, doc_id: np.ndarray, null: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the keys and which of them were found (their fingerprints agree)."""
        keys = _key_hash(doc_id, null, part)
        at = self.mph.slots(keys)
        got = self.slots[np.maximum(at, 0)] if len(self.slots) else np.zeros(len(keys), SLOT)
        return got, (at >= 0) & (got["fingerprint"] == _fingerprint(keys))


def _read(uri: str, name: str) -> bytes | None:
    files, base = pafs.FileSystem.from_uri(uri)
    if files.get_file_info(f"{base}/{name}").type != pafs.FileType.File:
        return None
    with files.open_input_file(f"{base}/{name}") as f:
        return f.read()


def locate(keys: DataFrame, uri: str, n_buckets: int, id_col: str = "doc_id") -> DataFrame:
    """Look every distinct key up in the index; a row per shard that holds it, none for a key that is not there."""
    rows = keys.select(F.col(id_col).cast("long").alias("doc_id")).distinct().withColumn("bucket", _bucket(n_buckets))

    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        data = _read(f"{uri}/index-{n_buckets}", f"bucket-{int(pdf['bucket'].iloc[0]):07d}.idx")
        out = {k: [] for k in ("doc_id", "null", "shard", "offset", "copies")}
        if data is not None:
            index = IndexBucket(data)
            null, key = pdf["doc_id"].isna().to_numpy(), pdf["doc_id"].fillna(0).to_numpy(np.int64)
            part = np.zeros(len(key), np.int64)
            while len(key):
                slot, found = index.lookup(key, null, part)
                for name, values in (("doc_id", key), ("null", null), ("shard", slot["shard"]), ("offset", slot["offset"]), ("copies", slot["copies"])):
                    out[name].append(values[found].astype(np.int64))
                more = found & (part + 1 < slot["parts"])
                key, null, part = key[more], null[more], part[more] + 1
        cols = {k: np.concatenate([*v, np.empty(0, np.int64)]) for k, v in out.items()}
        ids = pd.Series(cols.pop("doc_id"), dtype="Int64").mask(cols.pop("null").astype(bool))
        return pd.DataFrame({"doc_id": ids, **cols})

    return rows.groupBy("bucket").applyInPandas(bucket, "doc_id long, shard long, offset long, copies long")


class Shard:
    """Random access to one shard file: the footer at once, payloads by offset."""

    def __init__(self, uri: str, number: int):
        files, base = pafs.FileSystem.from_uri(f"{uri}/shards")
        self.file = files.open_input_file(f"{base}/{_shard_name(number)}")
        size = self.file.size()
        (self.width,) = struct.unpack("<I", self.file.read_at(12, 0)[8:])
        (n,) = struct.unpack("<Q", self.file.read_at(16, size - 16)[:8])
        tail = self.file.read_at(17 * n, size - 16 - 17 * n)
        self.lengths = np.frombuffer(tail, "<i8", n, 9 * n)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths

    def ids(self, offset: int, n_tokens: int) -> np.ndarray:
        data = self.file.read_at(n_tokens * self.width, 12 + offset * self.width)
        return np.frombuffer(data, f"<u{self.width}")


def fetch(located: DataFrame, uri: str, schema: str, derive) -> DataFrame:
    """Read the ids of located keys from their shards; ``derive(ids)`` gives the values of the columns in ``schema``."""
    names = [c.split()[0] for c in schema.split(",")]

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["shard"].iloc[0])
        s = Shard(uri, number)
        rows = []
        for key, offset, copies in pdf.sort_values("offset")[["doc_id", "offset", "copies"]].itertuples(index=False):
            at = int(np.searchsorted(s.starts, offset))
            for row in range(at, at + int(copies)):
                n = int(s.lengths[row])
                rows.append((None if pd.isna(key) else int(key), number, int(s.starts[row]), n, *derive(s.ids(int(s.starts[row]), n))))
        out = pd.DataFrame(rows, columns=["doc_id", "shard", "offset", "n_tokens", *names])
        return out.astype({"doc_id": "Int64"})

    return located.groupBy("shard").applyInPandas(shard, f"doc_id long, shard long, offset long, n_tokens long, {schema}")


def write(df: DataFrame, uri: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """Shards and index of a whole table; returns the runs and the number of index buckets."""
    runs = write_shards(df, uri, tokenizer_path, end_id, id_col, text_col)
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(width, -(-runs.count() // KEYS_PER_BUCKET))
    build_index(runs, uri, n_buckets).count()
    return runs, n_buckets


def _slot(f, key: np.ndarray) -> np.ndarray | None:
    """The slot of a hashed key in an open bucket file: the level sizes, one word a level, one slot."""
    n, levels = struct.unpack("<II", f.read_at(8, 8))
    sizes = struct.unpack(f"<{levels}I", f.read_at(4 * levels, 16))
    begin = 16 + 4 * levels
    slots = begin + WORD.itemsize * sum(sizes)
    for level, m in enumerate(sizes):
        at = int(PerfectHash._at(key, level, 64 * m)[0])
        word = np.frombuffer(f.read_at(WORD.itemsize, begin + WORD.itemsize * (at >> 6)), WORD)[0]
        bits, bit = int(word["bits"]), at & 63
        if bits >> bit & 1:
            number = int(word["before"]) + (bits & ((1 << bit) - 1)).bit_count()
            slot = np.frombuffer(f.read_at(SLOT.itemsize, slots + SLOT.itemsize * number), SLOT)[0]
            return slot if slot["fingerprint"] == _fingerprint(key)[0] else None
        begin += WORD.itemsize * m
    return None


def get(uri: str, n_buckets: int, doc_id: int | None) -> list[np.ndarray]:
    """The ids of every row with this key, by reads of fixed size but for the payload (and the lengths of rows that share the key)."""
    hashed = 42 if doc_id is None else xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()
    hashed -= (hashed >> 63) << 64
    files, base = pafs.FileSystem.from_uri(uri)
    bucket = f"{base}/index-{n_buckets}/bucket-{hashed % n_buckets:07d}.idx"
    out: list[np.ndarray] = []
    if files.get_file_info(bucket).type != pafs.FileType.File:
        return out
    with files.open_input_file(bucket) as index:
        part, parts = 0, 1
        while part < parts:
            slot = _slot(index, _key_hash(np.array([doc_id or 0]), np.array([doc_id is None]), np.array([part])))
            if slot is None:
                break
            with files.open_input_file(f"{base}/shards/{_shard_name(int(slot['shard']))}") as f:
                (width,) = struct.unpack("<I", f.read_at(4, 8))
                lengths, copies = [int(slot["n_tokens"])], int(slot["copies"])
                if copies > 1:
                    size = f.size()
                    (n,) = struct.unpack("<Q", f.read_at(8, size - 16))
                    lengths = np.frombuffer(f.read_at(8 * copies, size - 16 - 8 * (n - int(slot["row"]))), "<i8").tolist()
                at = 12 + int(slot["offset"]) * width
                for length in lengths:
                    out.append(np.frombuffer(f.read_at(length * width, at), f"<u{width}"))
                    at += length * width
            part, parts = part + 1, int(slot["parts"])
    return out


def read_back(keys: DataFrame, runs: DataFrame, uri: str, n_buckets: int) -> DataFrame:
    """Per stored row of the given keys: where its ids start in the whole corpus, their number and checksum."""
    got = fetch(locate(keys, uri, n_buckets), uri, "ids_crc32 long", lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),))
    sums = runs.groupBy("shard").agg(F.sum("run_tokens").alias("shard_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    starts = sums.select("shard", F.coalesce(F.sum("shard_tokens").over(before), F.lit(0)).alias("shard_start"))
    return got.join(starts, "shard").select("doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def uri_of(spark: SparkSession, path: str) -> str:
    """A path as a URI that the tasks can open."""
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
