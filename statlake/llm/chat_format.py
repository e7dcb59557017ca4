"""Chat formatting by schema fingerprints.

A *layout* is a set of nested field paths.  Its fingerprint is the hash of the
sorted paths, array elements written as ``[]``.  A registry maps fingerprints
to declarative mappings, SQL expressions that turn one record of that layout
into canonical turns ``array<struct<role, text>>``.  Two inputs are served:

* typed frames: the schema's own paths select the mapping, once per frame;
* JSON records: the paths present in each record select it, row by row; the
  records are read with the union of the registered fields.  A field counts as
  present if its name is there, also with a null value; a field of an array's
  elements, if any element has it.  A layout may name *optional* fields, which
  need not be there, and an empty array has all fields of its layout.

The *template* writes ``<turn>role\\ntext</turn>\\n`` per turn.  Inside roles
and texts ``\\`` becomes ``\\\\`` and ``<`` becomes ``\\l`` (and line breaks in
roles ``\\n``), so no text can contain a marker, and reading back is exact.
The loss mask lists the spans (start, length in code points) of the assistant
texts.  Everything is DataFrame functions.

Defined cases: null text or role counts as empty; a null or repeated turn
number is ordered by turn (nulls first), role, text; rows with a null
conversation id form one conversation; repeated rows are separate turns; an
unregistered layout raises for typed frames and gives null turns for records;
an empty table has no conversations; other columns are ignored.  A digest
over a whole conversation needs it in one place, so one conversation is one
row; its size is the caller's.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role string, text string>>"


def field_paths(schema: T.DataType, at: str = "") -> list[str]:
    """Leaf paths of a schema: ``a.b`` for structs, ``a[]`` for arrays, ``a{}`` for maps."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{at}[]")
    if isinstance(schema, T.MapType):
        return field_paths(schema.valueType, at + "{}")
    return [at]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Layout:
    """``schema`` (DDL) names the fields that make the fingerprint; ``turns`` is
    the mapping; ``rows`` marks layouts with one turn per row, whose mapping
    gives one turn and which name the conversation and the order."""

    name: str
    schema: str
    turns: str
    conversation: str | None = None
    order: str | None = None
    optional: tuple[str, ...] = ()

    @property
    def paths(self) -> list[str]:
        return sorted(field_paths(T.StructType.fromDDL(self.schema)))

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def _turn(role: str, text: str) -> str:
    return f"named_struct('role', {role}, 'text', {text})"


def _present(*turns: str) -> str:
    return f"filter(array({', '.join(turns)}), t -> t.text IS NOT NULL)"


LAYOUTS = [
    Layout("turn rows", "conv_id long, turn long, role string, text string",
           f"array({_turn('role', 'text')})", "conv_id", "turn"),
    Layout("messages", "messages array<struct<role: string, content: string>>",
           "transform(messages, m -> " + _turn("m.role", "m.content") + ")"),
    Layout("speaker messages", "conversations array<struct<from: string, value: string>>",
           "transform(conversations, m -> " + _turn(
               "CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.from END", "m.value") + ")"),
    Layout("instruction", "instruction string, input string, output string",
           "array(" + _turn("'user'", "concat_ws('\\n\\n', instruction, nullif(input, ''))") + ", "
           + _turn("'assistant'", "output") + ")", optional=("input",)),
    Layout("system instruction", "system string, instruction string, output string",
           _present(_turn("'system'", "system"), _turn("'user'", "instruction"), _turn("'assistant'", "output"))),
    Layout("prompt", "prompt string, response string",
           f"array({_turn(chr(39) + 'user' + chr(39), 'prompt')}, {_turn(chr(39) + 'assistant' + chr(39), 'response')})"),
    Layout("prompt completion", "prompt string, completion string",
           f"array({_turn(chr(39) + 'user' + chr(39), 'prompt')}, {_turn(chr(39) + 'assistant' + chr(39), 'completion')})"),
    Layout("nested data", "data struct<prompt: struct<text: string>, reply: struct<text: string>>",
           "array(" + _turn("'user'", "data.prompt.text") + ", " + _turn("'assistant'", "data.reply.text") + ")"),
]


def layout_of(schema: T.StructType, layouts: list[Layout] = LAYOUTS) -> Layout:
    """The layout whose paths the schema has; other columns may be there too.
    The exact fingerprint wins, else the largest layout contained in it."""
    have = field_paths(schema)
    known = {x.fingerprint: x for x in layouts}
    if (exact := known.get(fingerprint(have))) is not None:
        return exact
    inside = [x for x in layouts if set(x.paths) <= set(have)]
    if not inside:
        raise ValueError(f"no layout for the fields {sorted(have)}")
    return max(inside, key=lambda x: (len(x.paths), x.name))


def _clean(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"),
                                                 F.coalesce(t["text"], F.lit("")).alias("text")))


def canonical_turns(df: DataFrame, id_col: str | None = None, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """conv_id and turns of a typed frame, by its schema's fingerprint."""
    layout = layout_of(df.schema, layouts)
    if layout.conversation is None:
        return df.select(F.col(id_col).alias("conv_id"), _clean(F.expr(layout.turns)).alias("turns"))
    turn = F.expr(layout.turns)[0]
    row = F.struct(F.col(layout.order).alias("turn"), F.coalesce(turn["role"], F.lit("")).alias("role"),
                   F.coalesce(turn["text"], F.lit("")).alias("text"))
    return (df.select(F.col(layout.conversation).alias("conv_id"), row.alias("row"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
            .select("conv_id", F.transform("rows", lambda r: F.struct(r["role"], r["text"])).alias("turns")))


def record_turns(df: DataFrame, id_col: str, json_col: str, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, layout and turns of JSON records of mixed layouts.

    The record is read with the union of the fields of all layouts; the paths
    that are present, with a layout's optional ones added, are its fingerprint."""
    layouts = [x for x in layouts if x.conversation is None]
    fields: dict[str, T.StructField] = {}
    for x in layouts:
        for f in T.StructType.fromDDL(x.schema).fields:
            fields.setdefault(f.name, f)
    schema = T.StructType([fields[k] for k in sorted(fields)])
    paths = sorted({p for x in layouts for p in x.paths})

    def has(json: Column, path: str) -> Column:
        """Whether a JSON object has the field at ``path``, null or not."""
        parent, _, name = path.rpartition(".")
        inside = F.get_json_object(json, "$." + parent) if parent else json
        return F.coalesce(F.array_contains(F.json_object_keys(inside), name), F.lit(False))

    def elements(path: str) -> Column:
        return F.from_json(F.get_json_object(json_col, "$." + path), "array<string>")

    def there(path: str) -> Column:
        array, several, rest = path.partition("[].")
        if not several:
            return has(F.col(json_col), path)
        return F.coalesce(F.exists(elements(array), lambda e: has(e, rest)), F.lit(False))

    def empty(path: str) -> Column:
        array, several, _ = path.partition("[].")
        return F.coalesce(F.size(elements(array)) == 0, F.lit(False)) if several else F.lit(False)

    # one flag per path, evaluated once
    seen = F.struct(*[there(p).alias(f"p{k}") for k, p in enumerate(paths)], *[empty(p).alias(f"e{k}") for k, p in enumerate(paths)])
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for x in layouts:
        def present(k: int, p: str, x=x) -> Column:
            flag = F.col("__seen")[f"p{k}"]
            if p in x.optional:
                return F.lit(True)
            return flag | F.col("__seen")[f"e{k}"] if p in x.paths else flag
        mark = F.sha2(F.concat_ws("\n", *[F.when(present(k, p), F.lit(p)) for k, p in enumerate(paths)]), 256)
        name = F.when(mark == x.fingerprint, x.name).otherwise(name)
        turns = F.when(mark == x.fingerprint, F.expr(x.turns).cast(TURNS)).otherwise(turns)
    opened = df.select(F.col(id_col).alias("conv_id"), F.from_json(json_col, schema).alias("r"), seen.alias("__seen"))
    opened = opened.select("conv_id", "__seen", *[F.col("r")[f].alias(f) for f in sorted(fields)])
    return opened.select("conv_id", name.alias("layout"), _clean(turns).alias("turns"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    # a doubled backslash is set aside first; U+0000 stands for it and is itself doubled before
    mark = F.lit("\x00")
    out = F.replace(F.replace(text, mark, F.lit("\x00z")), F.lit("\\\\"), F.lit("\x00b"))
    out = F.replace(F.replace(out, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n"))
    return F.replace(F.replace(out, F.lit("\x00b"), F.lit("\\")), F.lit("\x00z"), mark)


OPEN, CLOSE = "<turn>", "</turn>\n"


def format_turns(df: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss_spans (array<struct<start, length>>, code points from 0)."""
    role = lambda t: F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n"))
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), role(t), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == loss_role).alias("loss")))
    sized = df.select("conv_id", parts.alias("parts")).select(
        "conv_id", "parts",
        F.transform("parts", lambda p: F.struct(F.char_length(p["head"]).alias("head"),
                                                F.char_length(p["body"]).alias("body"), p["loss"].alias("loss"))).alias("sizes"))
    spans = F.aggregate(
        "sizes", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["head"] + s["body"] + len(CLOSE)).alias("at"),
            F.when(s["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["head"]).alias("start"),
                                                                      s["body"].alias("length")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    text = F.concat_ws("", F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))))
    return sized.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(df: DataFrame) -> DataFrame:
    """conv_id, formatted, turns and loss_text, from the formatted text and its mask alone."""
    pieces = F.slice(F.split("formatted", CLOSE, -1), 1, F.size(F.split("formatted", CLOSE, -1)) - 1)
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text")))
    loss = F.concat_ws("", F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["length"]))))
    return df.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_text"))


def digests(df: DataFrame) -> DataFrame:
    """The result of ``read_back`` as counts and digests per conversation."""
    joined = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return df.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                     F.sha2(joined, 256).alias("turns_sha256"),
                     F.char_length("loss_text").cast("long").alias("loss_chars"),
                     F.sha2("loss_text", 256).alias("loss_sha256"),
                     F.char_length("formatted").cast("long").alias("formatted_chars"))
