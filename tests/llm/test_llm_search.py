"""Whitening, lexical search and line dedup against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from resale.llm import lexical, line_dedup, whitening

# --- whitening ---------------------------------------------------------------


def brute_whitening(rows, k=8):
    """Rows (id, vector) whitened through the eigenvectors of the exact covariance."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    wide = np.array([[n * r[j] - s[j] for j in range(d)] for r in x], dtype=object)
    v = np.array((wide.T @ wide) / (n**3), dtype=float)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    y = np.array(wide, dtype=float) / n
    return good, [sum(t * t for t in r) for r in wide.tolist()], y @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def vectors(rng, n, d, spread):
    return [[float(np.float32(c)) for c in rng.normal(size=d) * spread] for _ in range(n)]


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    rows = list(enumerate(vectors(rng, 400, 12, np.linspace(0.05, 1.5, 12))))
    rows += [(rows[0][0], rows[0][1])] * 130  # a group of copies
    rows += [(900, None), (901, [None] + [0.0] * 11), (902, [math.nan] * 12), (903, [math.inf] + [0.0] * 11), (904, [1.0] * 5), (905, []), (None, rows[5][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, whitened string").repartition(7)
    w = whitening.fit(df)
    out = whitening.transform(df, w).collect()
    good, deviation, white, explained = brute_whitening([r for r in rows if r[0] not in (904, 905)])
    assert len(out) == 8 * len(good) and w.centre.n == len(good)
    assert max(r.identity_error for r in out) < 1e-9
    want = collections.defaultdict(list)
    for (i, _), dev, z in zip(good, deviation, white):
        want[i].append((dev, z))
    sign = {}
    for r in out:
        dev, z = want[r.vec_id][0]
        sign.setdefault(r.component, 1 if r.whitened * z[r.component - 1] >= 0 else -1)
        assert r.deviation == dev == r.deviation_exact and r.n == len(good)
        assert abs(r.whitened - sign[r.component] * z[r.component - 1]) < 1e-8
        assert abs(r.explained - explained[r.component - 1]) < 1e-10
    assert collections.Counter(r.vec_id for r in out) == collections.Counter({i: 8 * len(v) for i, v in want.items()})


def test_whitening_of_few_dimensions_and_odd_tables(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-500, 500, size=(60, 3)) @ rng.integers(-2, 3, size=(3, 10))  # three dimensions in ten columns
    df = spark.createDataFrame([(i, [float(c) / 1024 for c in v]) for i, v in enumerate(base.tolist())], "vec_id long, embedding array<float>")
    w = whitening.fit(df)
    out = whitening.transform(df, w).collect()
    assert int(w.has_variance.sum()) == 3 and w.identity_error < 1e-9
    assert all((r.whitened is None) == (r.component > 3) for r in out) and len(out) == 480
    y = base - base.mean(axis=0)
    e = np.linalg.eigvalsh(y.T @ y)[::-1]
    assert np.allclose(w.variances[:3], e[:3] / 60, rtol=1e-9) and np.allclose(w.trace, e.sum() / 60, rtol=1e-9)
    empty = df.where("vec_id < 0")
    assert whitening.fit(empty) is None and whitening.transform(empty, None).count() == 0
    assert whitening.transform(empty, w).count() == 0
    one = df.where("vec_id = 0")
    rows = whitening.transform(one, whitening.fit(one)).collect()
    assert len(rows) == 8 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in rows)


def test_large_deviations_are_exact():
    c = whitening.Centre(3 * 10**9, [10**14 + 7, -(10**15)])
    x = np.array([[1 << 40, -(1 << 41)], [5, 6]])
    assert c.deviations(x) == [sum((c.n * int(v) - s) ** 2 for v, s in zip(r, c.sums)) for r in x.tolist()]


def test_block_solve():
    rng = np.random.default_rng(5)
    r = np.triu(rng.normal(size=(70, 70))) + 9 * np.eye(70)
    a = rng.normal(size=(11, 70))
    assert np.allclose(whitening._upper_solve(a, r) @ r, a)


# --- search ------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, top=10):
    parts = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n_docs, n_terms = sum(bool(p) for _, p in parts), sum(len(p) for _, p in parts)
    df = collections.Counter(t for _, p in parts for t in set(p))
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, p in parts:
            tf = collections.Counter(p)
            m = 10 + (90 * len(p) * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms if t in tf)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def texts_for_search(rng, n):
    words = [f"w{k}" for k in range(300)] + ["Éa", "straße", "猫", "x1"]
    weights = [1 / (k + 1) for k in range(len(words))]
    made = [" ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 200]))) for _ in range(n)]
    return made + [made[0]] * 30 + ["", None, " .,;- ", "W1 w1-W1", "the " * 3000]


@pytest.mark.parametrize("block", [(4096, 8 << 20, 1024), (60, 8 << 20, 16), (4096, 2000, 7)])
def test_search_equals_scoring_everything(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block[0])
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block[1])
    monkeypatch.setattr(lexical, "RANGE", block[2])
    rng = random.Random(block[2])
    docs = [(i * 3 % 701, t) for i, t in enumerate(texts_for_search(rng, 500))] + [(None, "w1 w2 straße")]
    items = [(k, " ".join(rng.choices([f"W{j}" for j in range(300)] + ["straße", "unknownterm"], k=rng.choice([1, 4, 30])))) for k in range(25)]
    items += [(3, "w299"), (40, None), (41, ""), (None, "w0 w7"), (42, "the")]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(lexical.build(d), q)
    want = brute_search(docs, items)
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()], key=str) == want
    again = lexical.search(lexical.build(d), q, max_terms=40)  # several rounds
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in again.collect()], key=str) == want


def test_search_odd_tables(spark):
    schema = "doc_id long, text string"
    none, some = spark.createDataFrame([], schema), spark.createDataFrame([(1, "a b"), (2, None)], schema)
    ask = spark.createDataFrame([(7, "b")], "item_id long, text string")
    assert lexical.search(lexical.build(none), ask).count() == 0
    assert lexical.search(lexical.build(some), ask.where("item_id = 0")).count() == 0
    assert lexical.search(lexical.build(spark.createDataFrame([(1, "..")], schema)), ask).count() == 0
    assert [tuple(r) for r in lexical.search(lexical.build(some), ask).collect()] == [(7, 1, 1, 287 * (10**9 // (1000 + 8 * 100)))]


def test_walk_skips_and_stays_exact():
    # long lists of small weight cannot bring a document in once the best scores are high
    n = 5000
    ids, lengths = np.arange(n, dtype="<i8").tobytes(), np.full(n, 50, "<u4").tobytes()
    rng = np.random.default_rng(1)
    lists = {}
    for k, share in enumerate((1.0, 0.9, 0.3, 0.01, 0.002)):
        at = np.flatnonzero(rng.random(n) < share).astype("<u4")
        lists[b"%d" % k] = (at.tobytes(), rng.integers(1, 9, len(at)).astype("<u4").tobytes())
    weights = {b"0": 1, b"1": 2, b"2": 900, b"3": 4000, b"4": 6000}
    block = lexical.Block((0, ids, lengths), lists, weights, n, n * 50)
    at, score = block.best(list(lists), 10)
    full = np.zeros(n, np.int64)
    for where, part, _ in block.lists.values():
        full[where] += part
    order = np.argsort(-full, kind="stable")[:10]
    assert at.tolist() == order.tolist() and score.tolist() == full[order].tolist()


# --- lines -------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def brute_lines(rows, least_chars=20, least_docs=3):
    low = -(2**63)
    held = collections.defaultdict(set)

    def key(line):
        return line.strip(SPACE).translate(LOWER)

    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                held[key(line)].add(low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(held.get(key(x), ())) >= least_docs and max(held[key(x)]) != (low if i is None else i))]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


def texts_with_lines(rng, n):
    pool = [f"line number {k} which is long enough é" for k in range(40)] + ["short one", "nineteen characters", "twenty characters ok", "   padded \x0b line that is long enough\t\r", "x" * 19 + "é"]
    hot = "Every third document holds this very line"
    rows = []
    for i in range(n):
        lines = rng.choices(pool, k=rng.choice([1, 3, 12]))
        lines += [hot.upper() if rng.random() < 0.5 else hot] * (i % 3 == 0) + [f"only here {i} and nowhere else at all"] * 2
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("width", [1, 8, 61])
def test_lines_equal_brute_force(spark, width):
    rng = random.Random(width)
    rows = texts_with_lines(rng, 300)
    rows += [(900, rows[7][1])] * 3 + [(7, rows[8][1]), (7, rows[7][1]), (None, rows[9][1]), (None, rows[3][1]), (-5, rows[9][1]), (910, None), (911, ""), (912, "\n\n"), (913, "a line of thirty characters...\n" * 5000)]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, bitmap string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", width)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else few rows share one range
        maps = line_dedup.keep_bitmaps(df).cache()
        got = sorted([tuple(r) for r in line_dedup.digests(df, maps).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()], key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_lines(rows)
    texts = [(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in line_dedup.apply(df, maps).collect()]
    assert sorted(texts, key=str) == sorted([(g[0], g[3]) for g in got], key=str)
    assert maps.where("n_dropped = 0").count() == 0


def test_lines_in_small_batches(spark):
    # a hash whose rows fill many Arrow batches
    rows = [(i, "this line is in every single document\n" + f"own line of document number {i}") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        got = sorted([tuple(r) for r in line_dedup.digests(df, line_dedup.keep_bitmaps(df)).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()], key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_lines(rows)


def test_lines_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.digests(none, line_dedup.keep_bitmaps(none)).count() == 0
    two = spark.createDataFrame([(i, "a line that only two documents have") for i in (1, 2, 2)], "doc_id long, text string")
    assert line_dedup.keep_bitmaps(two).count() == 0
    assert [r.n_dropped for r in line_dedup.digests(two, line_dedup.keep_bitmaps(two, least_docs=2)).orderBy("doc_id").collect()] == [1, 0, 0]
    with pytest.raises(ValueError):
        line_dedup.keep_bitmaps(two, least_docs=1)
    assert line_dedup.kept_lines(4, None).all()
