"""Byte-level BPE encoding and decoding from a rank file, with the tokenizers library over Arrow batches.

The rank file gives one byte string per id.  Each byte maps to one printable
character (the byte table below), so ranks become the vocabulary and the merge
list of a ``tokenizers`` BPE model; every match of the split pattern is encoded
on its own.  Decoding looks the token strings up and reverses the byte table;
bytes are joined before they are read as UTF-8, so a character split over
several tokens comes back whole.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows give repeated rows; an empty table gives an empty table; other
columns of the input are not read.  Very long texts are taken whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import models

from resale.llm.chunks import ChunkEncoder, byte_table
from resale.llm.common import keyed, slices, strings, trimmed


#: Bytes of text or ids handled at once.
SLICE = 1 << 20


class Codec:
    """Encoder and decoder of one vocabulary; kept by each Python worker."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        chars = byte_table()
        self.to_byte = {c: b for b, c in enumerate(chars)}
        shown = {tok: "".join(chars[x] for x in tok) for tok in ranks}
        merges = []
        for tok, _ in sorted(ranks.items(), key=lambda kv: kv[1]):
            pairs = [(tok[:i], tok[i:]) for i in range(1, len(tok)) if tok[:i] in ranks and tok[i:] in ranks]
            merges += [(shown[a], shown[b]) for a, b in sorted(pairs, key=lambda p: (ranks[p[0]], ranks[p[1]]))]
        self.model = models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
        size = max(ranks.values()) + 1
        self.token_bytes = [b""] * size
        for r in ranks.values():
            self.token_bytes[r] = bytes(self.to_byte[c] for c in self.model.id_to_token(r))
        self.lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self.chunks = ChunkEncoder(self.model, pattern, "I")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.chunks.encode(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of an id sequence; an id outside the vocabulary is an error."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Character span of each token; tokens that share a character all carry that character's span."""
        if not len(ids):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        char_of = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        return char_of[ends - self.lengths[ids]], char_of[ends - 1] + 1


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False, decoded: bool = False) -> DataFrame:
    """(doc_id, ids binary, n_tokens[, starts, ends][, decoded]) per row of ``df``; ``decoded`` is decoded from the ids in the same pass."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for b in slices(batches, "text", SLICE):
            ids = c.encode(strings(b.column("text")))
            cols = [b.column("doc_id"), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            names = ["doc_id", "ids", "n_tokens"]
            if offsets:
                spans = [c.offsets(a := np.frombuffer(x, "<u4"), c.decode(a)) for x in ids]
                cols += [pa.array([s.tolist() for s, _ in spans], pa.list_(pa.int64())), pa.array([e.tolist() for _, e in spans], pa.list_(pa.int64()))]
                names += ["starts", "ends"]
            if decoded:
                cols.append(pa.array([c.decode(np.frombuffer(x, "<u4")) for x in ids], pa.binary()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, ids binary, n_tokens long" + (", starts array<long>, ends array<long>" if offsets else "") + (", decoded binary" if decoded else "")
    return keyed(df, id_col, text_col).mapInArrow(trimmed(step), schema)


def decode(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds ``decoded`` (binary) to the output of :func:`encode`; cast it to string for the text."""
    names = df.columns

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for b in slices(batches, "ids", SLICE):
            data = [c.decode(np.frombuffer(x or b"", "<u4")) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(data, pa.binary())], [*names, "decoded"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(step, f"{fields}, decoded binary")


def digests(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode and decode every text: count and digests of the ids and of the decoded bytes."""
    out = encode(df, ranks_path, pattern, decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
