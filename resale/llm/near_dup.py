"""Near-duplicate documents from bottom-k sketches of one hash function.

A text's set holds the hashes of its distinct word shingles; its sketch the
``K`` smallest of them.  Texts with equal sets are one class, and one text of
each class goes on.  Inverted lists of retained values give the candidates:
with values ordered rarest first, two sketches that share ``need`` values must
meet in the lists of the first ``shared - need + 1`` shared values of each, so
common passages create no list unless they fill most of a sketch.

Documents are chained only where two sketches do share ``need`` values.  Each
member of a list is compared with the list's first document; members that this
chains to one another are done.  Lists that still hold several chains are mixed:
their members' sketches are brought together (long lists in cells of bounded
size) and overlaps counted between all of them, so texts that share a passage
but no more form no group.

The texts of a candidate group are brought together (large groups in blocks of
bounded size), where inverted lists of the sketches give overlaps, the sketch of
the union estimates the similarity, and the exact Jaccard of the full sets
confirms a link.  Cells and blocks return a spanning forest of their links, never
all pairs.  A large group is compared block by block; then the documents outside
its largest component meet every block, which covers every pair that could still
join two components.

``need`` follows from the similarity: exact for sets that fit into a sketch,
five standard deviations below the expected overlap for larger ones (about one
link in a million at the threshold itself, none above it in practice).

Defined results: a null or empty text, or one without words, has an empty set
and no links; a text with fewer words than a shingle is one shingle; rows with
equal ids are one document (they share a component); null ids likewise;
repeated rows give repeated rows; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resale.llm.common import free_names, keyed, slices, splitmix, trimmed, written
from resale.llm.components import components
from resale.llm.repetition import SLICE, ByteHash, word_ranges

K = 64
#: Percent of shared shingles among all shingles of two texts that makes a link.
PERCENT = 80
#: Documents and shingles that one block may hold.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 2_000_000
#: Sketches that one cell of a mixed list may hold.
CELL_DOCS = 4096
NULL_ID = -(2**63)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x2545F4914F6CDD1D)
_OTHER = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text in ``data`` (UTF-8 bytes of all texts)."""
    data = _LOWER[data]
    begins, ends, first = word_ranges(data, bounds)
    words = ByteHash(data).of(begins, ends)
    roll = words
    for at in range(1, size):
        roll = roll[:-1] * _STEP + words[at:] if len(roll) else roll
    roll = splitmix(roll)
    powers = np.multiply.accumulate(np.full(size, _OTHER, np.uint64))
    out = []
    for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
        if e - s >= size:
            out.append(np.unique(roll[s : e - size + 1]))
        elif e > s:
            whole = (words[s:e] * powers[: e - s]).sum(dtype=np.uint64) + np.uint64(e - s)
            out.append(splitmix(np.array([whole])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string array without nulls."""
    text = arr.cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = text.buffers()[2]
    return (np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)), offsets - offsets[0]


def features(df: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, sig binary, sketch array) per row; ``sig`` identifies the whole set."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            sets = shingle_sets(*text_buffer(b.column("text")), size)
            sigs = []
            for s in sets:
                m = splitmix(s)
                sigs.append(np.array([m.sum(dtype=np.uint64), splitmix(m ^ _OTHER).sum(dtype=np.uint64)], "<u8").tobytes())
            sketches = [s[:K].view(np.int64) for s in sets]
            lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(s) for s in sketches])].astype(np.int32), pa.array(np.concatenate([*sketches, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary()), lists], ["doc_id", "n", "sig", "sketch"])

    rows = keyed(df, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)))
    return written(rows.mapInArrow(trimmed(step), "doc_id long, n long, sig binary, sketch array<long>"), "features")


def need_of(n, percent: int):
    """Least number of sketch values that a document of ``n`` shingles shares with a linked one (a Column)."""
    p = percent / 100
    large = math.floor(K * p - 5 * math.sqrt(K * p * (1 - p)) - 1)
    return F.when(n * p <= large, F.ceil(n * percent / F.lit(100))).otherwise(F.lit(large)).cast("int")


def candidate_groups(feats: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, grp) of the documents whose sketches share enough values with another's; ``feats`` has one row per class."""
    entries = feats.where("n > 0").select("doc_id", "n", F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    met = entries.join(shared, "value")
    lists = met.groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("v"))  # K values at most
    need = need_of(F.col("n"), percent)
    lists = lists.where(F.size("v") >= need).select("doc_id", F.explode(F.slice("v", F.lit(1), F.size("v") - need + 1)).alias("e"))
    lists = written(lists.select("doc_id", F.col("e.value").alias("value")), "lists")
    centers = lists.groupBy("value").agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("last")).where("center != last")
    edges = lists.join(centers, "value").where("doc_id != center").select("doc_id", "center").distinct()
    # sketches of the documents in lists only, with the number of values to share
    sketches = written(feats.join(lists.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "sketch", need_of(F.col("n"), percent).alias("need")), "sketches")
    own, first = sketches.alias("s"), sketches.select(F.col("doc_id").alias("center"), F.col("sketch").alias("c_sketch"), F.col("need").alias("c_need"))
    compared = edges.join(own, "doc_id").join(first, "center")
    near = written(compared.where(F.size(F.array_intersect("sketch", "c_sketch")) >= F.greatest("need", "c_need")).select(F.col("doc_id").alias("a"), F.col("center").alias("b")), "near")
    more = _mixed_lists(lists, sketches, components(near, "a", "b"))
    found = components(near.union(more), "a", "b").select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))
    return feats.select("doc_id", "n").join(found, "doc_id")


def _mixed_lists(lists: DataFrame, sketches: DataFrame, chains: DataFrame) -> DataFrame:
    """Links (a, b) between sketches of different chains that share enough values, from the lists that hold several chains."""
    chained = lists.join(chains.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("value", "doc_id", F.coalesce("component", "doc_id").alias("label"))
    mixed = chained.groupBy("value").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("m"),
        F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.sum(F.xxhash64(F.lit(1), "doc_id").cast("decimal(38,0)")).alias("y"),
    ).where("low != high")
    # lists with the same members (the values of one passage) are compared once
    mixed = mixed.groupBy("m", "x", "y").agg(F.min("value").alias("value")).select("value", F.ceil(F.col("m") / CELL_DOCS).cast("int").alias("cells"))
    members = chained.join(mixed, "value").join(sketches, "doc_id")
    mine = F.pmod(F.xxhash64(F.lit(2), "doc_id"), "cells").cast("int")
    others = F.explode(F.transform(F.sequence(F.lit(0), F.col("cells") - 1), lambda j: F.struct(F.least(F.col("mine"), j).alias("i"), F.greatest(F.col("mine"), j).alias("j"))))
    cells = members.withColumn("mine", mine).select("value", "doc_id", "label", "sketch", "need", "mine", others.alias("cell")).select("value", "cell.*", "doc_id", "label", "mine", "sketch", "need")

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        b = pa.concat_batches(parts)
        doc = b.column("doc_id").to_pylist()
        flat, ends = b.column("sketch").flatten().to_numpy(), np.cumsum(np.asarray(pa.compute.list_value_length(b.column("sketch"))))
        apart = b.column("i")[0].as_py() != b.column("j")[0].as_py()
        found = sketch_links(np.split(flat, ends[:-1]), b.column("need").to_numpy(), b.column("label").to_pylist(), b.column("mine").to_numpy() if apart else None)
        return pa.RecordBatch.from_pydict({"a": pa.array([doc[i] for i, _ in found], pa.int64()), "b": pa.array([doc[j] for _, j in found], pa.int64())})

    dealt = cells.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j")
    return written(dealt.mapInArrow(trimmed(_by_run(["value", "i", "j"], links)), "a long, b long"), "mixed-links")


def _by_run(keys: list[str], make):
    """A step that calls ``make`` with the batches of each run of equal keys that has two rows or more."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts = None, []
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(k).to_numpy() for k in keys]
            cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
            for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                key = tuple(c[at] for c in cols)
                if key != last:
                    if sum(p.num_rows for p in parts) > 1:
                        yield make(parts)
                    last, parts = key, []
                parts.append(b.slice(at, end - at))
        if sum(p.num_rows for p in parts) > 1:
            yield make(parts)

    return step


class _Forest:
    """Union-find over positions of a block."""

    def __init__(self, labels: list):
        first: dict = {}
        self.root = np.array([first.setdefault(x, i) for i, x in enumerate(labels)])

    def join(self, a: int, b: int) -> None:
        ra, rb = self.root[a], self.root[b]
        self.root[self.root == rb] = ra


def sketch_links(sketches: list[np.ndarray], need: np.ndarray, labels: list, sides: np.ndarray | None) -> list[tuple[int, int]]:
    """A spanning forest, over the chains ``labels``, of the pairs whose sketches share what both need.

    With ``sides``, only pairs of different sides are compared.
    """
    m = len(sketches)
    values, owner = np.concatenate(sketches), np.repeat(np.arange(m), [len(s) for s in sketches])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    forest, out = _Forest(labels), []
    for d in range(1, m):
        lo, hi = np.searchsorted(values, sketches[d]), np.searchsorted(values, sketches[d], side="right")
        met = np.concatenate([owner[x:y] for x, y in zip(lo.tolist(), hi.tolist())])
        fits = (np.bincount(met[met < d], minlength=d) >= np.maximum(need[:d], need[d])) & (forest.root[:d] != forest.root[d])
        if sides is not None:
            fits &= sides[:d] != sides[d]
        for i in np.flatnonzero(fits).tolist():
            if forest.root[i] != forest.root[d]:
                forest.join(i, d)
                out.append((i, d))
    return out


def block_links(sets: list[np.ndarray], labels: list, sides: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of one block.

    ``labels`` are components that are known already; with ``sides``, only pairs
    of different sides are compared.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    width = np.minimum(sizes, K)
    sketch = np.full((m, K), np.uint64(2**64 - 1))
    for i, s in enumerate(sets):
        sketch[i, : width[i]] = s[:K]
    values, owner = np.concatenate([s[:K] for s in sets]), np.repeat(np.arange(m), width)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    p = percent / 100
    floor = p - 5 * math.sqrt(p * (1 - p) / K)
    forest, out = _Forest(labels), []
    for d in range(1, m):
        mine = sets[d][:K]
        lo, hi = np.searchsorted(values, mine), np.searchsorted(values, mine, side="right")
        met = np.concatenate([owner[x:y] for x, y in zip(lo.tolist(), hi.tolist())] + [np.empty(0, np.int64)])
        overlap = np.bincount(met[met < d], minlength=d)
        small, large = np.minimum(sizes[:d], sizes[d]), np.maximum(sizes[:d], sizes[d])
        fits = (overlap > 0) & (forest.root[:d] != forest.root[d]) & (100 * small >= percent * large)
        if sides is not None:
            fits &= sides[:d] != sides[d]
        c = np.flatnonzero(fits)
        if not len(c):
            continue
        # shared values among the K smallest of the union
        theirs = sketch[c]
        below = np.searchsorted(mine, theirs)
        same = mine[np.minimum(below, len(mine) - 1)] == theirs
        rank = np.arange(K) + below - (np.cumsum(same, axis=1) - same)
        union = np.minimum(K, width[c] + width[d] - overlap[c])
        estimate = (same & (rank < K)).sum(axis=1) / union
        c = c[np.argsort(-estimate, kind="stable")][: int((estimate >= floor).sum())]
        while len(c):
            part, c = c[:32], c[32:]
            joined = np.concatenate([sets[i] for i in part])
            at = np.minimum(np.searchsorted(sets[d], joined), sizes[d] - 1)
            both = np.add.reduceat(sets[d][at] == joined, np.r_[0, np.cumsum(sizes[part])[:-1]], dtype=np.int64)
            for i in part[100 * both >= percent * (sizes[part] + sizes[d] - both)]:
                if forest.root[i] != forest.root[d]:
                    forest.join(int(i), d)
                    out.append((int(i), d))
            c = c[forest.root[c] != forest.root[d]]
    return out


def _compare(rows: DataFrame, size: int, percent: int, sided: bool) -> DataFrame:
    """Links (a, b) found in the blocks of ``rows`` (doc_id, text, grp, block, label, side)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a block keeps the sets of its texts, never the texts
        key, docs, labels, sides, sets = None, [], [], [], []

        def links() -> pa.RecordBatch:
            found = block_links(sets, labels, np.array(sides) if sided else None, percent)
            return pa.RecordBatch.from_pydict({"a": pa.array([docs[i] for i, _ in found], pa.int64()), "b": pa.array([docs[j] for _, j in found], pa.int64())})

        for b in slices(batches, "text", SLICE):
            found = shingle_sets(*text_buffer(b.column("text")), size)
            cols = [b.column(c).to_pylist() for c in ("grp", "block", "doc_id", "label", "side")]
            for grp, number, doc, label, side, own in zip(*cols, found):
                if (grp, number) != key:
                    if len(docs) > 1:
                        yield links()
                    key, docs, labels, sides, sets = (grp, number), [], [], [], []
                docs.append(doc)
                labels.append(label)
                sides.append(side)
                sets.append(own)
        if len(docs) > 1:
            yield links()

    dealt = rows.select("grp", "block", "doc_id", "text", "label", "side").repartition("grp", "block").sortWithinPartitions("grp", "block")
    return written(dealt.mapInArrow(trimmed(step), "a long, b long"), "links")


def links_in_groups(docs: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """All links that matter for components; ``docs`` (doc_id, text) holds the texts, ``groups`` (doc_id, n, grp)."""
    blocks = groups.groupBy("grp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id"), "blocks")
    members = written(groups.join(blocks, "grp").select("doc_id", "grp", "blocks", own.alias("own")), "members")
    first = members.select("doc_id", "grp", F.col("own").alias("block"), F.col("doc_id").alias("label"), F.lit(0).alias("side"))
    found = _compare(docs.join(first, "doc_id"), size, percent, sided=False)
    large = members.where("blocks > 1")
    if large.isEmpty():
        return found
    parts = components(found, "a", "b").select(F.col("node").alias("doc_id"), F.col("component").alias("label"))
    large = written(large.join(parts, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id")), "large")
    most = large.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("m")).groupBy("grp").agg(F.max_by("label", F.struct("m", F.col("label"))).alias("top"))
    outside = large.join(most, "grp").where("label != top").drop("top")
    counts = outside.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).cast("long").alias("rounds"))
    # block number = own block of the right side, and which share of the outside documents is on the left
    left = outside.join(counts, "grp").select(
        "doc_id", "grp", "label", F.lit(0).alias("side"),
        F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: b * F.col("rounds") + F.pmod(F.xxhash64("doc_id", F.lit(1)), "rounds"))).alias("block"),
    )
    right = large.join(counts, "grp").select(
        "doc_id", "grp", "label", F.lit(1).alias("side"),
        F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("rounds") - 1), lambda r: F.col("own") * F.col("rounds") + r)).alias("block"),
    )
    return found.union(_compare(docs.join(left.unionByName(right), "doc_id"), size, percent, sided=True))


def near_duplicates(df: DataFrame, size: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``df``."""
    feats = features(df, size, id_col, text_col)
    # one row per class, combined before the shuffle: the smallest id with the set's sketch
    reps = feats.where("n > 0").groupBy("sig").agg(F.min(F.struct("doc_id", "n", "sketch")).alias("r"))
    reps = written(reps.select("sig", "r.doc_id", "r.n", "r.sketch"), "classes")
    classes = reps.select("sig", F.col("doc_id").alias("rep"))
    groups = candidate_groups(reps.drop("sig"), percent)
    rows = keyed(df, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)))
    links = links_in_groups(rows, groups, size, percent)
    # rows with one id and several sets are one document
    ids = feats.where("n > 0").select("sig", "doc_id").distinct()
    several = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id")
    aliases = ids.join(several, "doc_id").join(classes, "sig").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = components(links.union(aliases), "a", "b")
    named = classes.join(labels, F.col("rep") == F.col("node"), "left").select("sig", F.coalesce("component", "rep").alias("component_id"))
    out = feats.select("doc_id", "n", "sig").join(named, "sig", "left")
    own = F.nullif(F.col("doc_id"), F.lit(NULL_ID))
    component = F.nullif(F.coalesce("component_id", "doc_id"), F.lit(NULL_ID))
    return out.select(own.alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), own.eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all columns of ``docs``; of repeated rows one stays."""
    found = near_duplicates(docs, size, percent, id_col, text_col)
    per_id = written(found.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")), "kept")
    key, copies = free_names(docs, "id", "copies")
    ids = per_id.select(F.col("doc_id").alias(key), F.col("copies").alias(copies))
    stay = docs.join(ids, docs[id_col].cast("long").eqNullSafe(ids[key]))
    once = stay.where(ids[copies] == 1)
    if per_id.where("copies > 1").isEmpty():
        return once.drop(key, copies)
    rest = stay.where(ids[copies] > 1).dropDuplicates([key])
    return once.unionByName(rest).drop(key, copies)
