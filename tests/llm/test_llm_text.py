"""Encoding, token store, chat formatting, language ID and repetition against plain versions of the same rules."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from resale.llm import bpe, chat, language, repetition, token_store
from resale.llm.common import scratch

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, n_tokens string"
ODD = [
    None, "", " ", "  a  b", "\n\n x\n", "it's we'll THEY'RE", "aaaaaaaaaaaa", "日本語 🙂 é", "x" * 3000, "a\x1cb \x85  c", "</s>[INST] ok", "1234 ٣ ²", "=====  ----", "word, word. word",
]
WORD = re.compile("[^\x20\x09-\x0d]+")


def odd_rows(spark):
    """Nulls, ties, repeated rows, and columns whose names clash with those of results."""
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)] + [(3, ODD[3], "x", "y"), (3, "another text", "x", "y"), (None, "no key", "x", "y"), (None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def reference_encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_on_random_text():
    enc, codec = reference_encoding(), bpe.Codec(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(2)
    alphabet = ["a", "aa", "e", " ", "  ", "\n", "'s", "'", "é", "日", "🙂", "1", "23", "!", "--", "===", "\x1c", "\x85", " ", "the", "ing", "\r\n", "ſ", "́"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(4000)]
    for text, got in zip(texts, codec.encode(texts)):
        ids = np.frombuffer(got, "<u4")
        assert ids.tolist() == enc.encode_ordinary(text)
        assert codec.decode(ids).decode() == text
        starts, ends = codec.offsets(ids, codec.decode(ids))
        assert "".join(text[s:e] for s, e in zip(starts, ends) if e > s)[:1] == text[:1]
        assert not len(ids) or (starts[0] == 0 and ends[-1] == len(text))


def test_bpe_rows(spark):
    enc = reference_encoding()
    got = sorted(tuple(r) for r in bpe.digests(odd_rows(spark).fillna(-1, "doc_id"), RANKS, public_tokenizers.PATTERN).collect())
    want = []
    for r in odd_rows(spark).fillna(-1, "doc_id").collect():
        ids = enc.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digests(odd_rows(spark).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    encoded = bpe.encode(odd_rows(spark), RANKS, public_tokenizers.PATTERN, offsets=True)
    back = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).select(F.col("decoded").cast("string").alias("t"), "starts").collect()
    assert collections.Counter(r.t for r in back) == collections.Counter(r.text or "" for r in odd_rows(spark).collect())


def test_token_store_round_trip(spark):
    df = odd_rows(spark)
    uri = token_store.uri_of(spark, scratch(spark, "store"))
    runs, buckets = token_store.write(df, uri, JSON, 2)
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in token_store.read_back(df, runs, uri, buckets).collect())
    tok = Tokenizer.from_file(JSON)
    tok.encode_special_tokens = True
    ids = {(r.doc_id, r.text): [*tok.encode(r.text or "", add_special_tokens=False).ids, 2] for r in df.collect()}
    want = collections.Counter((r.doc_id, len(ids[r.doc_id, r.text]), zlib.crc32(np.array(ids[r.doc_id, r.text], "<u4").tobytes())) for r in df.collect())
    assert got == want
    starts = sorted((r.start, r.n_tokens) for r in token_store.read_back(df, runs, uri, buckets).collect())
    at = 0
    for start, n in starts:
        assert start == at
        at += n
    assert sorted(x.tolist() for x in token_store.get(uri, buckets, 3)) == sorted(ids[3, t] for t in (ODD[3], ODD[3], "another text"))
    assert len(token_store.get(uri, buckets, None)) == 2
    assert token_store.get(uri, buckets, 99999) == []
    foreign = spark.createDataFrame([(i,) for i in range(1000, 3000)], "doc_id long")
    assert token_store.locate(foreign, uri, buckets).count() == 0


def test_added_tokens_as_in_the_library():
    """The library's default call, without any flag set."""
    rng = random.Random(12)
    tok = Tokenizer.from_file(JSON)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x  <|endoftext|>", "a <|endoftext", "", *[t or "" for t in ODD]]
    texts += ["".join(rng.choices(["<|endoftext|>", " ", "  ", "\n", "word", "'s", "<|", "é日", "12"], k=rng.randint(0, 30))) for _ in range(300)]
    enc = token_store.IdEncoder(JSON)
    got = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] == [64, 50256, 65]


def test_token_store_empty_table(spark):
    df = odd_rows(spark).limit(0)
    uri = token_store.uri_of(spark, scratch(spark, "store"))
    runs, buckets = token_store.write(df, uri, JSON, 2)
    assert runs.count() == 0
    assert token_store.read_back(df, runs, uri, buckets).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64))
    mph = token_store.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))


CONTROL_TEXTS = ["<|turn|>", "<\\|turn|>", "<\\\\|end|> x <|end|>", "</s>[INST] ok [/INST]", "<<SYS>>a<</SYS>>", "<|text|><|text|>", "[[INST]", "\\", "<", "", "a\nb", "<|tur<|end|>n|>"]


def test_chat_escapes_are_reversible(spark):
    rng = random.Random(4)
    parts = [*CONTROL_TEXTS, "|turn|>", "<", "\\", "[", "INST]", "s>", "/s>"]
    texts = CONTROL_TEXTS + ["".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert not any(first + rest in r.e for first, rests in chat.CONTROL.items() for rest in rests)


def test_chat_turns_and_loss(spark):
    rows = [(1, i, role, t) for i, (role, t) in enumerate(zip(["system", "user", "assistant"] * 4, CONTROL_TEXTS))]
    rows += [(2, 0, None, None), (None, 0, "assistant", "x"), (3, 5, "assistant", "b"), (3, 5, "assistant", "b"), (3, None, "a\n<|text|>", "first")]
    df = spark.createDataFrame(rows, chat.TURN_SCHEMA).withColumn("formatted", F.lit("clash")).withColumn("loss", F.lit(0))
    turns = chat.turns_of_table(df)
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(turns)).collect()}
    groups = collections.defaultdict(list)
    for c, n, role, text in rows:
        groups[c].append(((n is not None, n or 0), role or "", text or ""))
    assert set(got) == set(groups)
    for c, items in groups.items():
        items.sort()
        assert got[c].n_turns == len(items)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in items).encode()).hexdigest()
        loss = "".join(t for _, r, t in items if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_turns(turns.limit(0)).count() == 0


def test_chat_layouts(spark):
    records = [
        (1, '{"prompt": "p", "completion": "c"}'), (2, '{"completion": "c2", "prompt": null}'), (3, '{"instruction": "i", "input": "n", "output": "o"}'),
        (4, '{"messages": [{"role": "user", "content": "u"}, {"content": "a", "role": "assistant"}]}'), (5, '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}'),
        (6, '{"strange": 1}'), (7, "not json"), (8, None),
    ]
    df = spark.createDataFrame(records, "k long, j string")
    got = collections.defaultdict(list)
    for r in chat.turns_of_records(df, "k", "j").orderBy("conv_id", "turn").collect():
        got[r.conv_id].append((r.role, r.text))
    assert dict(got) == {
        1: [("user", "p"), ("assistant", "c")], 2: [("user", ""), ("assistant", "c2")], 3: [("system", "i"), ("user", "n"), ("assistant", "o")],
        4: [("user", "u"), ("assistant", "a")], 5: [("user", "h"), ("assistant", "g")],
    }
    assert sorted(r.conv_id for r in chat.unknown_layouts(df, "k", "j").collect()) == [6, 7, 8]
    with pytest.raises(ValueError):
        chat.turns_of_table(df)


def test_chat_tables_by_fingerprint(spark):
    """The hash of a table's field paths selects its mapping; other columns do not count."""
    from pyspark.sql import Row

    def turns(df):
        return sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.turns_of_table(df, id_col="k").collect())

    plain = spark.createDataFrame([(1, "i", None, "o", 5)], "k long, instruction string, input string, output string, score int")
    assert turns(plain) == [(1, 0, "system", "i"), (1, 1, "user", ""), (1, 2, "assistant", "o")]
    assert turns(plain.drop("input")) == [(1, 0, "user", "i"), (1, 1, "assistant", "o")]
    said = spark.createDataFrame([Row(k=2, conversations=[Row(**{"from": "human", "value": "h", "weight": 1}), Row(**{"from": "gpt", "value": None, "weight": 2})])])
    assert turns(said) == [(2, 0, "user", "h"), (2, 1, "assistant", "")]
    known = {x.name: x for x in chat.LAYOUTS}
    assert chat.select_layout(["conv_id", "turn", "role", "text", "formatted", "prompt"]) is known["turn_rows"]
    assert chat.select_layout(["prompt", "completion", "response"]) is known["prompt_completion"]
    assert chat.select_layout(["prompt"]) is None and chat.select_layout([]) is None
    one = spark.range(1).select(*[chat.fingerprint(F.lit(x.skeleton)).alias(x.name) for x in chat.LAYOUTS]).first()
    assert all(one[x.name] == chat.fingerprint_of(x.skeleton) for x in chat.LAYOUTS)


def brute_repetition(text: str) -> dict[str, int]:
    w = WORD.findall(text)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    out["n_dup_lines"] = again
    for n in repetition.LIMITS:
        grams = collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        covered = {j for i in range(len(w) - n + 1) if grams[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        out[f"chars_{n}"] = sum(len(w[i]) for i in covered)
        if n == 5:
            out["n_repeat_words"] = len(covered)
    return out


def test_repetition_equals_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = ["".join(rng.choices(["a ", "b ", "é ", "\n", "  ", "a\nb ", "\t", "#x ", "日本 ", "\r\n", "c", "\x0b"], k=rng.choice([0, 1, 3, 30, 90]))) for _ in range(rng.randint(1, 6))]
        data = [t.encode() for t in texts]
        m = repetition.measure(np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(x) for x in data])].astype(np.int64))
        for i, t in enumerate(texts):
            want = brute_repetition(t)
            assert {k: int(m[k][i]) for k in want} == want


def test_equal_hashes_are_equal_texts():
    """Thue-Morse words and their complements collide under every odd base modulo a power of two."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    lines = [word[:2048], word[2048:4096], word[:2048].translate(str.maketrans("ab", "ba"))]
    text = "\n".join([lines[0], lines[1], "x y", lines[0]])
    data = np.frombuffer(text.encode(), np.uint8)
    m = repetition.measure(data, np.array([0, len(data)]))
    assert m["n_dup_lines"][0] == brute_repetition(text)["n_dup_lines"] == 1 + (lines[0] == lines[1])
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 70_000).astype(np.uint8)
    at = rng.integers(0, 60_000, 4000)
    ends = at + rng.integers(1, 12, 4000)
    hashed = repetition.ByteHash(data).of(at, ends)
    first = {}
    for h, a, e in zip(hashed.tolist(), at.tolist(), ends.tolist()):
        assert first.setdefault(h, data[a:e].tobytes()) == data[a:e].tobytes()
    assert len(first) == len({data[a:e].tobytes() for a, e in zip(at, ends)})
    long = repetition.ByteHash(np.tile(data, 12)).of(np.array([5, 70_005, 500_000]), np.array([300, 70_300, 500_295]))  # beyond the kept powers
    assert long[0] == long[1] != long[2]


def test_repetition_rows(spark):
    df = odd_rows(spark)
    got = repetition.score(df).collect()
    assert len(got) == df.count()
    empty = [r for r in got if r.doc_id == 0][0]
    assert empty.n_words == 0 and empty.base_failed and not empty.kept
    assert repetition.score(df.limit(0)).count() == 0
    many = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "a b c d e " * 40)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in repetition.score(many).collect()} == {1: True, 2: False}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.where(~held_out))
    got = language.predict(docs.where(held_out), model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.95
    assert got.score.between(0, 1).all()
    assert got.rejected.mean() < 0.01


def test_language_rejects_what_it_never_saw(spark):
    """Random letters, base64 and unseen languages go, also when the training rows hold junk; clean documents stay."""
    rng = random.Random(6)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n)) for n in (30, 100, 300, 1000, 3000) for _ in range(6)]
    noise += [base64.b64encode(rng.randbytes(4 * n)).decode() for n in (30, 100, 300, 1000, 3000) for _ in range(6)]
    noise += [
        "La mattina il mercato della piazza si riempie di voci e di colori, e le persone comprano frutta, verdura e pane fresco prima di tornare a casa. Nel pomeriggio i bambini giocano nel parco mentre i nonni leggono il giornale.",
        "Aamulla tori täyttyy äänistä ja väreistä, ja ihmiset ostavat hedelmiä, vihanneksia ja tuoretta leipää ennen kuin he palaavat kotiin. Iltapäivällä lapset leikkivät puistossa ja isovanhemmat lukevat lehteä.",
        "Sabahları pazar yeri sesler ve renklerle dolar, insanlar eve dönmeden önce meyve, sebze ve taze ekmek alırlar. Öğleden sonra çocuklar parkta oynarken büyükanneler ve büyükbabalar gazete okur.",
    ]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    junk = spark.createDataFrame([(-1, "zq", "en"), (-2, "xkcd qwz", "fr"), (-3, "ﾊﾛｰ", "de")], docs.schema)
    model = language.fit(docs.where("doc_id % 4 > 0").unionByName(junk))
    got = language.predict(spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string"), model).collect()
    assert [noise[r.doc_id][:40] for r in got if not r.rejected] == []
    clean = language.predict(docs.where("doc_id % 4 = 0"), model).toPandas()
    assert len(clean) > 200 and clean.rejected.mean() < 0.01


def test_language_scores_equal_plain_cosines(spark):
    """Counts, weights and cosines written out in loops."""
    train = spark.createDataFrame([(i, f"{['hello my world', 'bonjour le monde', 'hallo du welt'][i % 3]} {chr(97 + i % 7)}", ["en", "fr", "de"][i % 3]) for i in range(60)], "doc_id long, text string, lang string")
    model = language.fit(train)
    texts = ["hello world", "le monde, bonjour!", "Ünd so weiter 12", "zzz"]
    got = language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        low = "".join(c if c.isalpha() else " " for c in texts[r.doc_id].lower())
        low = f" {' '.join(low.split())} "
        count = collections.Counter()
        for n in language.ORDERS:
            for k in range(len(low) - n + 1):
                h = 0
                for c in low[k : k + n]:
                    h = (h * 1000003 + ord(c)) % 2**64
                count[(h * 0x9E3779B97F4A7C15 + n) % 2**64 >> 52] += 1
        weight = {d: np.log1p(c) * float(model.idf[d]) for d, c in count.items()}
        size = sum(w * w for w in weight.values()) ** 0.5
        cosines = [sum(w / size * float(g[d]) for d, w in weight.items()) for g in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert r.lang_pred == model.languages[model.owners[best]] and abs(r.score - cosines[best]) < 1e-5
    assert language.predict(train.limit(0), model).count() == 0
    # many rows that share one sampled id, and ids with several languages
    same = train.unionByName(spark.createDataFrame([(3, f"bonjour {k}", ["fr", "en"][k % 2]) for k in range(500)], train.schema))
    assert language.fit(same).languages == ["de", "en", "fr"]
    with pytest.raises(ValueError):
        language.fit(train, max_languages=2)


def test_language_blocks_and_odd_rows(spark, monkeypatch):
    rng = random.Random(1)
    for _ in range(100):
        t = "".join(rng.choices(["a", "b", "é", " ", "  ", "1", ".", "\n", "ß"], k=rng.randint(0, 60)))
        whole = language.counts(t)
        with monkeypatch.context() as m:
            m.setattr(language, "BLOCK", rng.randint(1, 9))
            parts = language.counts(t)
        assert (whole is None and parts is None) or (whole == parts).all()
    train = spark.createDataFrame([(i, ["hello world", "bonjour le monde"][i % 2], ["en", "fr"][i % 2], "z") for i in range(20)], "doc_id long, text string, lang string, score string")
    model = language.fit(train)
    got = language.predict(odd_rows(spark), model).collect()
    assert len(got) == odd_rows(spark).count()
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2)} == {"und"}
    assert language.fit(train.limit(0)) is None
    assert {r.lang_pred for r in language.predict(train, None).collect()} == {"und"}
    kept = language.keep_accepted(train.withColumn("rejected", F.lit(True)), model)
    assert kept.columns == [*train.columns, "rejected"] and kept.count() == 20
