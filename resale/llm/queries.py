"""Registered queries of the training-data operators: production parameters over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resale.llm import blob_ledger, bpe, chat, decontaminate, html_extract, language, lexical, line_dedup, near_dup, repetition, token_store, toxicity, whitening
from resale.llm.common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]
END_ID = 2


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every document, then read each document back through the index."""
    docs = table(spark, sf_dir, "documents")
    uri = token_store.uri_of(spark, scratch(spark, "token-store"))
    runs, buckets = token_store.write(docs, uri, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_store.read_back(docs.select("doc_id"), runs, uri, buckets)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation, and one made of control strings, and read the output back."""
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], chat.TURN_SCHEMA)
    turns = chat.turns_of_table(table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_turns(turns.unionByName(extra)))


def _escapes(c: str) -> str:
    rests = [f"\\{x}\\\\*(?:{'|'.join(chat._quoted(r) for r in rs)})" for x, rs in chat.CONTROL.items()]
    return f"len(regexp_extract_all({c}, '{'|'.join(rests)}'))"


OP2_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(chat.TURN + chat.TEXT + chat.END)} + length(r) + length(x) + {_escapes('r')} + {_escapes('x')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows whose crc32(doc_id) mod 4 is 2 are held out of the training."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.where(~held_out))
    return language.predict(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets overlap by 80 percent or more."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=4)


OP4_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS g
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x AS doc_id, x AS reached FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached),
m AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, coalesce(m.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each document holds."""
    return decontaminate.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP5_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_OP5_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_OP5_WORDS} AS ws FROM benchmark),
ds AS (SELECT doc_id, len(ws) AS n, unnest(range(0, greatest(len(ws) - 4, 0))) AS p, unnest(list_transform(range(1, greatest(len(ws) - 3, 1)), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM d),
bs AS (SELECT item_id, len(ws) AS w, unnest(range(0, greatest(len(ws) - 4, 0))) AS q, unnest(list_transform(range(1, greatest(len(ws) - 3, 1)), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM b),
a AS (SELECT DISTINCT doc_id, n, item_id, w, p FROM ds JOIN bs USING (g)),
v AS (SELECT DISTINCT doc_id, item_id, w, greatest(0, least(s, greatest(n - w, 0))) AS s
  FROM (SELECT doc_id, n, item_id, w, unnest(range(p - w + 5, p + 1)) AS s FROM a)),
wc AS (SELECT v.doc_id, v.item_id, v.s, ds.g, count(*) AS c FROM v JOIN ds ON ds.doc_id = v.doc_id AND ds.p >= v.s AND ds.p <= v.s + v.w - 5 GROUP BY ALL),
wt AS (SELECT doc_id, item_id, s, sum(c) AS t FROM wc GROUP BY ALL),
bc AS (SELECT item_id, g, count(*) AS c FROM bs GROUP BY ALL),
bt AS (SELECT item_id, sum(c) AS t FROM bc GROUP BY ALL),
m AS (SELECT doc_id, item_id, s, sum(least(wc.c, bc.c)) AS x FROM wc JOIN bc USING (item_id, g) GROUP BY ALL),
h AS (SELECT DISTINCT doc_id, item_id FROM m JOIN wt USING (doc_id, item_id, s) JOIN bt USING (item_id) WHERE 100 * x >= 80 * (wt.t + bt.t - x)),
r AS (SELECT doc_id, count(*) AS k, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS ids FROM h GROUP BY doc_id)
SELECT documents.doc_id, coalesce(k, 0) AS n_items, coalesce(ids, '') AS item_ids, k IS NULL AS kept FROM documents LEFT JOIN r USING (doc_id)
"""


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.main_text(pages, html_extract.fit(pages))


def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition counts, coverage and verdict of every document."""
    return repetition.score(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows whose crc32(doc_id) mod 5 is 0 are held out of the training."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan every document through a new ledger and join the findings back to all documents."""
    ledger = blob_ledger.Ledger(spark, scratch(spark, "ledger"))
    run = ledger.update(table(spark, sf_dir, "documents"))
    return blob_ledger.digests(ledger.results(run))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the rank file, and the bytes decoded from them."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the whitening on all usable vectors, and whiten every one of them."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.transform(vectors, whitening.fit(vectors))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index every document, and rank them all for every benchmark item."""
    return lexical.search(lexical.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents),
st AS (SELECT count(*) AS nd, sum(len(ts)) AS nt FROM d WHERE len(ts) > 0),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark)),
tf AS (SELECT rid, doc_id, n, t, count(*) AS f FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * k + 1 AS DOUBLE))) AS BIGINT) AS weight FROM (SELECT t, count(*) AS k FROM tf GROUP BY t), st),
s AS (SELECT item_id, rid, doc_id, sum(weight * ((1000000000 * f) // (1000 * f + 8 * (10 + (90 * n * nd) // nt)))) AS score
  FROM q JOIN w USING (t) JOIN tf USING (t) CROSS JOIN st GROUP BY item_id, rid, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS pos FROM s WHERE score > 0)
SELECT item_id, CAST(pos AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE pos <= 10
"""


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep bitmaps of all documents, applied to them."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup.digests(docs, line_dedup.keep_bitmaps(docs))


_LINE_KEY = _LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM d),
k AS (SELECT *, {_LINE_KEY} AS key FROM l),
g AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""

QUERIES: dict[str, Query] = {
    "op1_token_store": op1_token_store,
    "op2_chat_format": op2_chat_format,
    "op3_language_id": op3_language_id,
    "op4_minhash": op4_minhash,
    "op5_decontaminate": op5_decontaminate,
    "op6_html_extract": op6_html_extract,
    "op7_repetition": op7_repetition,
    "op8_toxicity": op8_toxicity,
    "op9_secret_scan": op9_secret_scan,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_whitening": op11_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_line_dedup": op13_line_dedup,
}
ORACLES: dict[str, str] = {"op2_chat_format": OP2_SQL, "op4_minhash": OP4_SQL, "op5_decontaminate": OP5_SQL, "op12_lexical_search": OP12_SQL, "op13_line_dedup": OP13_SQL}
