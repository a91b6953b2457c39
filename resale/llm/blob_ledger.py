"""Secret scans over an incremental ledger of blobs, with DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content.  The
ledger (Parquet tables in one folder) holds ``versions`` (path key, blob),
``scanned`` (blob, rule version) and ``findings`` (blob, rule version, spans).
A run records the versions it is given, scans one copy of each blob that this
rule version has not seen, appends the findings, and joins them back to all
paths that ever held the blob.  The blobs to scan are written down first; if
there are none, no text is read again.  The scan stands above the join that picks
their copies, inside a generator, where the optimizer cannot move it below.

Spans come from splitting a text at a rule's matches: the lengths of what lies
between and of the matches add up to code-point positions.

Defined results: a null text is the empty blob; a null path key is a key like
any other; repeated rows give repeated rows; equal start positions are ordered
by the rules' order; an empty table gives an empty table; other columns are not
read.  Texts are scanned whole.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resale.llm.common import free_names, keyed, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, a cheap test that all matches pass, and the least length of one group."""

    kind: str
    pattern: str
    hint: str
    group: int = 0
    least: int = 1


#: Base kinds come first and stay as they are; the others are fixed values of public credential formats.  No pattern
#: starts anew at every character of a long run: a look-behind or a bound (of a URL's scheme) keeps the time linear.
RULES = [
    Rule("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "(?i)(?:passw|secret|token|api_?key)", 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA", 0, 18),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{16}", 0, 16),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\\s]*-----END [A-Z ]*PRIVATE KEY-----)?", "PRIVATE KEY"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-", 0, 15),
    Rule("jwt", "(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", "eyJ"),
    Rule("url_login", "[a-z][a-z0-9+.-]{0,30}://[^\\s/:@]+:[^\\s/:@]+@", "://[^\\s/:@]+:[^\\s/:@]+@"),
]
RULE_VERSION = "3"
BASE_KINDS = ("assign", "access", "hex")
SPAN = "array<struct<start: int, kind_no: int, kind: string, end: int>>"


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Spans of one rule's matches, leftmost and non-overlapping; matches that are too short are dropped."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    rows = F.arrays_zip(F.transform(found, F.length).alias("m"), F.transform(measured, F.length).alias("g"), F.transform(F.slice(between, 1, F.size(found)), F.length).alias("b"))
    empty = F.array().cast(SPAN)
    walked = F.aggregate(
        rows, F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, r: F.struct(
            (acc["at"] + r["b"] + r["m"]).alias("at"),
            F.when(
                r["g"] >= rule.least,
                F.concat(acc["out"], F.array(F.struct((acc["at"] + r["b"]).alias("start"), F.lit(number).alias("kind_no"), F.lit(rule.kind).alias("kind"), (acc["at"] + r["b"] + r["m"]).alias("end")))),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(rule.hint), walked).otherwise(empty)


def scan(text: Column, rules: list[Rule] = RULES) -> Column:
    """All spans of a text by start, then by the order of the rules."""
    return F.array_sort(F.concat(*[spans_of(text, r, i) for i, r in enumerate(rules)]))


class Ledger:
    """The ledger's tables in one folder of a shared store."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    SCHEMAS = {
        "versions": "doc_id long, blob binary, run string",
        "scanned": "blob binary, rule_version string",
        "findings": f"blob binary, rule_version string, spans {SPAN}",
    }

    def read(self, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        if not at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
            return self.spark.createDataFrame([], self.SCHEMAS[name])
        return self.spark.read.schema(self.SCHEMAS[name]).parquet(path)

    def append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").parquet(f"{self.path}/{name}")

    def update(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES, rule_version: str = RULE_VERSION) -> str:
        """Record the versions in ``docs`` and scan what this rule version has not seen; returns the run's name."""
        run = uuid.uuid4().hex
        rows = keyed(docs, id_col, text_col)
        addressed = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("blob"), "text")
        self.append(addressed.select("doc_id", "blob", F.lit(run).alias("run")), "versions")
        mine = self.read("versions").where(F.col("run") == run)
        done = self.read("scanned").where(F.col("rule_version") == rule_version).select("blob")
        # one copy of each unseen blob; the ids alone are grouped, so a blob with many copies costs one row a task
        holders = written(mine.groupBy("blob").agg(F.min("doc_id").alias("holder")).join(done, "blob", "left_anti"), "unseen")
        if holders.isEmpty():
            return run
        found = self.unseen_spans(addressed, holders, rules)
        # rows that repeat both key and text are scanned alike; one of them is kept
        once = found.where(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("spans"))
        self.append(once.select("blob", F.lit(rule_version).alias("rule_version"), "spans"), "findings")
        # last, so that a run that broke off is scanned again
        self.append(holders.select("blob", F.lit(rule_version).alias("rule_version")), "scanned")
        return run

    @staticmethod
    def unseen_spans(addressed: DataFrame, holders: DataFrame, rules: list[Rule]) -> DataFrame:
        """(blob, spans) of the texts that ``holders`` (blob, holder) names."""
        same = (F.col("a.blob") == F.col("h.blob")) & F.col("a.doc_id").eqNullSafe(F.col("h.holder"))
        unseen = addressed.alias("a").join(holders.alias("h"), same).select("a.blob", "a.text")
        return unseen.select("blob", F.explode(F.array(scan(F.col("text"), rules))).alias("spans"))

    def results(self, run: str | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
        """(doc_id, blob, spans) of every version of every path, or of one run."""
        paths = self.read("versions")
        paths = (paths if run is None else paths.where(F.col("run") == run)).select("doc_id", "blob")
        found = self.read("findings").where(F.col("rule_version") == rule_version).dropDuplicates(["blob"]).select("blob", "spans")
        return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digests(results: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of their spans, and all spans, per path."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [(F.size("kinds") - F.size(F.array_remove("kinds", k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return results.withColumn("kinds", F.col("spans.kind")).select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, results: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by ``[kind]``; overlapping spans are one; all columns stay.

    ``results`` must come from a run over these very rows: a text's blob gives its spans.
    """
    blob, spans = free_names(docs, "blob", "spans")
    found = results.where(F.size("spans") > 0).select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob])
    text = F.col(text_col)
    merged = F.aggregate(
        F.col(spans), F.array().cast("array<struct<start: int, end: int, kind: string>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"), F.element_at(acc, -1)["kind"].alias("kind"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))),
    )
    masked = F.aggregate(
        merged, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.lit(2**31 - 1))),
    )
    joined = docs.withColumn(blob, F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))).join(found, blob, "left")
    return joined.withColumn(text_col, F.when(F.col(spans).isNotNull(), masked).otherwise(text)).drop(blob, spans)
