"""Chat formatting with DataFrame functions only.

*Layouts.*  A record's layout is the set of its nested field paths; a
fingerprint (hash of the sorted paths) selects a declarative mapping from a
registry, and the mapping says which paths hold the turns.  A table has one
fingerprint, taken from its schema: of the paths whose hash some mapping knows
(other columns do not count), or, if that hash is not registered, of the largest
layout among them.  JSON records have one per row, taken from the paths of their
parsed value.  Both kinds end in canonical turns ``(conv_id, turn, role, text)``.

*Template.*  Each turn becomes ``<|turn|>role<|text|>text<|end|>``.  Control
strings inside roles and texts (those of this template and common foreign
ones) get a backslash after their first character, one more if there are some
already, so that removing one restores the original.  The loss mask is the
list of code-point spans that hold assistant texts.

Defined results: null roles and texts are empty; a null conversation id is one
conversation of its own; turns are ordered by turn (null first), role, text;
repeated rows are repeated turns; a record whose layout is not registered
gives no turns and is returned by :func:`unknown_layouts`; a table whose layout
is not registered is an error; an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings by their first character and the rest (fixed values of common chat templates, and our own).
CONTROL = {
    "<": ["|turn|>", "|text|>", "|end|>", "|im_start|>", "|im_end|>", "|im_sep|>", "|endoftext|>", "|user|>", "|assistant|>", "|system|>", "s>", "/s>", "<SYS>>", "</SYS>>"],
    "[": ["INST]", "/INST]"],
}
TURN_SCHEMA = "conv_id long, turn long, role string, text string"


def _quoted(s: str) -> str:
    return "".join(f"\\{c}" if c in "|[]<>/." else c for c in s)


def escape(c: Column) -> Column:
    """Make control strings in a text inert; :func:`unescape` reverses it."""
    starts = [f"\\{x}(?=\\\\*(?:{'|'.join(map(_quoted, rs))}))" for x, rs in CONTROL.items()]
    return F.regexp_replace(c, f"({'|'.join(starts)})", "$1\\\\")


def unescape(c: Column) -> Column:
    parts = [f"(?<=\\{x})\\\\(?=\\\\*(?:{'|'.join(map(_quoted, rs))}))" for x, rs in CONTROL.items()]
    return F.regexp_replace(c, "|".join(parts), "")


# --- layouts ---------------------------------------------------------------


def schema_paths(schema: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a schema; array elements are ``[]``."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, f"{at}[]")
    return [at]


def skeleton_of(paths: list[str]) -> str:
    return ",".join(sorted(paths))


def fingerprint(skeleton: Column) -> Column:
    return F.xxhash64(skeleton)


def fingerprint_of(text: str) -> int:
    """:func:`fingerprint` of a known string."""
    h = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return h - ((h >> 63) << 64)


@dataclass(frozen=True)
class Layout:
    """A layout and where its turns are.

    ``paths`` are its nested field paths.  Either ``rows`` names the columns
    (conversation, turn, role, text) of a table with a row per turn, or
    ``turns`` lists (role, path) of single texts in order, or ``messages`` is
    (array path, role field, text field).  ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    rows: tuple[str, str, str, str] | None = None
    turns: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def skeleton(self) -> str:
        return skeleton_of(list(self.paths))


_SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("prompter", "user"), ("bot", "assistant"))
LAYOUTS = [
    Layout("turn_rows", ("conv_id", "turn", "role", "text"), rows=("conv_id", "turn", "role", "text")),
    Layout("prompt_completion", ("prompt", "completion"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", ("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("instruction", ("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", ("instruction", "input", "output"), turns=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("messages", ("messages[].role", "messages[].content"), messages=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), messages=("conversations", "from", "value"), roles=_SPEAKERS),
]


def _role(c: Column, layout: Layout) -> Column:
    out = F.coalesce(c, F.lit(""))
    for old, new in layout.roles:
        out = F.when(c == old, new).otherwise(out)
    return out


def registry(layouts: list[Layout]) -> dict[int, Layout]:
    """Mappings by the fingerprint of their layout."""
    return {fingerprint_of(x.skeleton): x for x in layouts}


def select_layout(paths: list[str], layouts: list[Layout] = LAYOUTS) -> Layout | None:
    """The mapping whose fingerprint these field paths have, or of the largest layout they hold (of equal ones the first)."""
    known = {fingerprint_of(p) for x in layouts for p in x.paths}
    mine = [p for p in paths if fingerprint_of(p) in known]
    by_fingerprint = registry(layouts)
    hit = by_fingerprint.get(fingerprint_of(skeleton_of(mine)))
    if hit:
        return hit
    held = [x for x in layouts if set(x.paths) <= set(mine)]
    return max(held, key=lambda x: len(x.paths), default=None)


def turns_of_table(df: DataFrame, layouts: list[Layout] = LAYOUTS, id_col: str = "conv_id") -> DataFrame:
    """Canonical turns of a table; the fingerprint of its schema selects the mapping.

    Layouts with a row per turn name their conversation column; of other ones ``id_col`` is the key.
    """
    found = select_layout(schema_paths(df.schema), layouts)
    if found is None:
        raise ValueError(f"no mapping for the layout {skeleton_of(schema_paths(df.schema))}")
    if found.rows:
        conv, turn, role, text = found.rows
        return df.select(
            F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
            _role(F.col(role).cast("string"), found).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        )
    if found.messages:
        path, role, text = found.messages
        turns = F.transform(F.col(path), lambda m: F.struct(_role(m[role].cast("string"), found).alias("role"), F.coalesce(m[text].cast("string"), F.lit("")).alias("text")))
    else:
        turns = F.array(*[F.struct(F.lit(r).alias("role"), F.coalesce(F.col(p).cast("string"), F.lit("")).alias("text")) for r, p in found.turns])
    rows = df.select(F.col(id_col).cast("long").alias("conv_id"), F.posexplode(turns).alias("turn", "m"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "m.role", "m.text")


def record_skeleton(value: Column) -> Column:
    """Sorted field paths of a parsed JSON record: objects, and objects inside arrays one level down."""
    shape = F.schema_of_variant(value)
    inner = F.regexp_extract_all(shape, F.lit("(\\w+): ARRAY<OBJECT<([^<>]*)>>"), F.lit(0))
    nested = F.flatten(F.transform(inner, _array_paths))
    flat = F.regexp_replace(F.regexp_replace(shape, "\\w+: ARRAY<OBJECT<[^<>]*>>,? ?", ""), "^OBJECT<|>$", "")
    plain = F.regexp_extract_all(flat, F.lit("(\\w+): "), F.lit(1))
    return F.array_join(F.array_sort(F.concat(plain, nested)), ",")


def _array_paths(s: Column) -> Column:
    name = F.regexp_extract(s, "^(\\w+): ", 1)
    fields = F.regexp_extract_all(F.regexp_extract(s, "OBJECT<([^<>]*)>", 1), F.lit("(\\w+): "), F.lit(1))
    return F.transform(fields, lambda f: F.concat(name, F.lit("[]."), f))


def _records(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    value = F.try_parse_json(F.col(json_col).cast("string"))
    rows = df.select(F.col(id_col).cast("long").alias("conv_id"), value.alias("v"))
    return rows.withColumn("layout", fingerprint(F.coalesce(record_skeleton("v"), F.lit(""))))


def _messages(x: Layout) -> Column:
    path, role, text = x.messages
    raw = F.try_variant_get("v", f"$.{path}", f"array<struct<`{role}` string, `{text}` string>>")
    return F.transform(raw, lambda m: F.struct(_role(m[role], x).alias("role"), F.coalesce(m[text], F.lit("")).alias("text")))


def turns_of_records(df: DataFrame, id_col: str, json_col: str, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """Canonical turns of JSON records of any registered layouts, mixed in one column."""
    one = "array<struct<role string, text string>>"
    turns = F.lit(None).cast(one)
    for x in (x for x in layouts if not x.rows):
        if x.messages:
            got = _messages(x)
        else:
            got = F.array(*[F.struct(F.lit(r).alias("role"), F.coalesce(F.try_variant_get("v", f"$.{p}", "string"), F.lit("")).alias("text")) for r, p in x.turns])
        turns = F.when(F.col("layout") == fingerprint(F.lit(x.skeleton)), got).otherwise(turns)
    rows = _records(df, id_col, json_col).select("conv_id", F.posexplode(turns).alias("turn", "m"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "m.role", "m.text")


def unknown_layouts(df: DataFrame, id_col: str, json_col: str, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """Records whose layout no mapping covers (or that are not JSON): conv_id and field paths."""
    known = F.array(*[fingerprint(F.lit(x.skeleton)) for x in layouts if not x.rows])
    rows = _records(df, id_col, json_col).where(~F.array_contains(known, F.col("layout")))
    return rows.select("conv_id", F.coalesce(record_skeleton("v"), F.lit("")).alias("paths"))


# --- template --------------------------------------------------------------


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) per conversation; ``loss`` holds (start, length) in code points of assistant texts."""
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    body = escape(F.col("text"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    rows = turns.select("conv_id", "turn", "role", "text", head.alias("head"), body.alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END)))
    rows = rows.select(
        "conv_id", "role", "piece", F.row_number().over(in_order).alias("n"), F.length("body").alias("size"),
        (F.sum(F.length("piece").cast("long")).over(in_order) - F.length("body") - len(END)).alias("start"),
    )
    piece = F.struct("n", "piece", (F.col("role") == "assistant").alias("is_loss"), "start", "size")
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    masked = F.transform(F.filter("p", lambda x: x["is_loss"]), lambda x: F.struct(x["start"].alias("start"), x["size"].cast("long").alias("size")))
    return convs.select("conv_id", F.concat_ws("", F.col("p.piece")).alias("formatted"), masked.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read from a formatted conversation."""
    pieces = F.filter(F.split(formatted, _quoted(END)), lambda s: s != "")
    return F.transform(
        pieces,
        lambda s: F.struct(
            unescape(F.substring_index(F.substring(s, len(TURN) + 1, 2**31 - 1), TEXT, 1)).alias("role"),
            unescape(F.substring(s, F.instr(s, TEXT) + len(TEXT), F.lit(2**31 - 1))).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.concat_ws("", F.transform(loss, lambda x: unescape(F.substring(formatted, (x["start"] + 1).cast("int"), x["size"].cast("int")))))


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests read back from formatted conversations."""
    rows = chats.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("lt"))
    joined = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length("lt").cast("long").alias("loss_chars"), F.sha2("lt", 256).alias("loss_sha256"), "formatted_chars",
    )
