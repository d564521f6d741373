"""Chat formatting: heterogeneous conversation records into one reversible template, with a loss mask.

Only DataFrame functions. The nested field paths of a record are hashed; the hash selects a
declarative mapping to canonical turns (``array<struct<role, text>>``).

Defined results: a null role or text is an empty string; turns of one conversation are ordered by
turn, then role, then text (nulls first), so ties and repeated rows have one order; rows with a
null conversation id form one conversation; columns that no layout names are ignored; a record
that fits no layout, or has no messages, is kept as one row without turn (its layout null, if it fits none), and becomes
a conversation without text. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"


class Layout(NamedTuple):
    """A record layout: the field paths it is known by, and how its turns are written as SQL."""

    name: str
    paths: tuple[str, ...]
    turns: str
    turn: str | None = None  # where the number of its turn is, of a layout of single turns


#: Layouts of single records, most specific first where one contains another.
LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), "transform(messages, m -> struct(m.role AS role, m.content AS text))"),
    Layout(
        "speakers",
        ("conversations[].from", "conversations[].value"),
        "transform(conversations, m -> struct(CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.from END AS role, m.value AS text))",
    ),
    Layout(
        "instruction with input",
        ("input", "instruction", "output"),
        "array(struct('user' AS role, concat_ws('\\n\\n', instruction, nullif(input, '')) AS text), struct('assistant' AS role, output AS text))",
    ),
    Layout("instruction", ("instruction", "output"), "array(struct('user' AS role, instruction AS text), struct('assistant' AS role, output AS text))"),
    Layout(
        "system prompt",
        ("prompt", "response", "system"),
        "array(struct('system' AS role, system AS text), struct('user' AS role, prompt AS text), struct('assistant' AS role, response AS text))",
    ),
    Layout("prompt", ("prompt", "response"), "array(struct('user' AS role, prompt AS text), struct('assistant' AS role, response AS text))"),
    Layout("turn", ("role", "text", "turn"), "array(struct(CAST(role AS STRING) AS role, CAST(text AS STRING) AS text))", "turn"),
)
#: All fields the layouts name, as a schema to parse JSON records with.
RECORD = (
    "conv_id bigint, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, "
    "instruction string, input string, output string, system string, prompt string, response string, turn bigint, role string, text string"
)
#: The same arrays with whatever fields their elements have.
ARRAYS = "messages array<map<string,string>>, conversations array<map<string,string>>"
KNOWN = tuple(sorted({p for layout in LAYOUTS for p in layout.paths}))


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema: ``a``, ``a.b``, ``a[].b``."""
    out = []
    for field in schema.fields:
        kind, path = field.dataType, prefix + field.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        out += schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return out


def record_paths(json: Column) -> Column:
    """The known field paths that a JSON record has, sorted; an array has those of all its elements."""
    held = F.from_json(json, ARRAYS)
    found = []
    for path in KNOWN:
        top, _, inner = path.partition("[].")
        if inner:
            there = F.exists(held[top], lambda m: F.array_contains(F.map_keys(m), inner))
        else:
            there = F.array_contains(F.json_object_keys(json), top)
        found.append(F.when(there, F.lit(path)))
    return F.array_compact(F.array(*found))


def layout_of(paths: Column) -> Column:
    """Name of the layout whose fingerprint the paths have; else of the first layout they contain; else null."""
    hashed = F.sha2(F.array_join(paths, "\n"), 256)
    exact = [F.when(hashed == fingerprint(x.paths), F.lit(x.name)) for x in LAYOUTS]
    wide = [F.when(F.size(F.array_except(F.array(*map(F.lit, x.paths)), paths)) == 0, F.lit(x.name)) for x in LAYOUTS]
    return F.coalesce(*exact, *wide)


def _exploded(rows: DataFrame, turns: Column, turn: Column) -> DataFrame:
    """A row per turn; a record without any keeps a row of its own. ``turn`` is null where turns are numbered by their place."""
    numbered = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), "layout", turn.cast("bigint").alias("own"), F.posexplode_outer(turns).alias("place", "t"))
    return numbered.select("conv_id", F.coalesce("own", F.col("place").cast("bigint")).alias("turn"), "t.role", "t.text", "layout", F.col("t").isNotNull().alias("is_turn"))


def turns_of_json(records: DataFrame, json: str = "json") -> DataFrame:
    """Rows (conv_id, turn, role, text, layout, is_turn) of JSON records, each by the layout its own fields select."""
    parsed = records.select(F.from_json(json, RECORD).alias("r"), layout_of(record_paths(F.col(json))).alias("layout")).select("r.*", "layout")
    turns, turn = F.lit(None).cast(TURNS), F.lit(None)
    for layout in LAYOUTS:
        own = F.col("layout") == layout.name
        turns = F.when(own, F.expr(layout.turns).cast(TURNS)).otherwise(turns)
        turn = turn if layout.turn is None else F.when(own, F.col(layout.turn)).otherwise(turn)
    return _exploded(parsed, turns, turn)


def turns_of_table(df: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, layout, is_turn) of a typed table; its schema's fingerprint selects the mapping."""
    paths = schema_paths(df.schema)
    known = sorted(set(paths) & set(KNOWN))
    by_hash = {fingerprint(x.paths): x for x in LAYOUTS}
    layout = by_hash.get(fingerprint(known)) or next((x for x in LAYOUTS if set(x.paths) <= set(known)), None)
    if layout is None or "conv_id" not in paths:
        raise ValueError(f"no layout has the fields {', '.join(paths)}")
    named = df.withColumn("layout", F.lit(layout.name))
    if layout.turn is not None:  # a row is a turn already
        columns = [F.col(layout.turn).cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")]
        return named.select(F.col("conv_id").cast("bigint").alias("conv_id"), *columns, "layout", F.lit(True).alias("is_turn"))
    return _exploded(named, F.expr(layout.turns).cast(TURNS), F.lit(None))


# ------------------------------------------------------------------ template

#: A turn is ``### role: text </turn>`` and a line break. Inside role and text these characters are written as escapes.
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))
HEAD, COLON, END = "### ", ": ", " </turn>\n"


def escape(c: Column) -> Column:
    for plain, written in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescape(c: Column) -> Column:
    """Split at escaped backslashes, left to right, so that every other backslash begins an escape."""

    def plain(part: Column) -> Column:
        for char, written in ESCAPES[1:]:
            part = F.replace(part, F.lit(written), F.lit(char))
        return part

    return F.array_join(F.transform(F.split(c, r"\\\\", -1), plain), "\\")


def format_turns(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    ``loss_spans`` are (start, bytes) of the escaped texts of the trained role, in bytes of the
    UTF-8 form. Rows whose ``is_turn`` is false (if there is such a column) are no turns. The text of a conversation is one value by definition, so the rows of one
    conversation meet in one task; positions come from a running sum, which spills.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(HEAD), escape(role), F.lit(COLON))
    there = F.col("is_turn") if "is_turn" in turns.columns else F.lit(True)
    rows = turns.select(
        "conv_id", "turn", F.col("role").alias("said_by"), F.col("text").alias("said"), head.alias("head"), escape(text).alias("body"),
        (role == trained).alias("trained"), there.alias("there"),
    )
    piece = F.concat("head", "body", F.lit(END))
    before = "sum(IF(there, octet_length(head) + octet_length(body) + {}, 0)) OVER (PARTITION BY conv_id ORDER BY turn, said_by, said ROWS BETWEEN UNBOUNDED PRECEDING AND {})"
    placed = rows.select(
        "conv_id",
        piece.alias("piece"),
        F.expr("row_number() OVER (PARTITION BY conv_id ORDER BY turn, said_by, said)").alias("n"),
        (F.expr(before.format(len(END), "CURRENT ROW")) - len(END) - F.octet_length("body")).alias("start"),
        F.octet_length("body").cast("bigint").alias("bytes"),
        "trained",
        "there",
    )
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("there"), F.struct("n", "piece", "start", "bytes", "trained")))).alias("p"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("p", lambda x: x.piece), "").alias("formatted"),
        F.transform(F.filter("p", lambda x: x.trained), lambda x: F.struct(x.start.alias("start"), x.bytes.alias("bytes"))).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as ``array<struct<role, text>>``."""
    parts = F.split(formatted, END, -1)
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda x: F.struct(
            unescape(F.substring_index(F.substr(x, F.lit(len(HEAD) + 1)), COLON, 1)).alias("role"),
            unescape(F.substr(x, F.instr(x, COLON) + len(COLON))).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    raw = F.encode(formatted, "UTF-8")
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.decode(F.substring(raw, s.start.cast("int") + 1, s.bytes.cast("int")), "UTF-8"))), ""
    )
