"""Chat formatting: fingerprints of a record's nested field paths select a declarative
mapping that turns its layout into canonical turns, which a reversible template formats.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Names of the scalar types in the schema text of a variant.
SCALARS = r"\b(STRING|BIGINT|VOID|BOOLEAN|DOUBLE|FLOAT|DATE|TIMESTAMP_NTZ|TIMESTAMP|BINARY|DECIMAL\(\d+,\d+\))(?=[,>]|$)"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.

    fields: the layout's field paths ([] marks array elements). turns: (role, path)
    for each turn in order, where a role `$.x` is read from the record. each: path of
    an array of messages, with role and text fields; roles are renamed by `roles`.
    Turns with a role in `optional` are left out when their text is missing or empty.
    """

    name: str
    fields: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()


ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

MAPPINGS = (
    Mapping("turn_rows", ("conv_id", "turn", "role", "text"), (("$.role", "$.text"),)),
    Mapping("messages", ("messages[].role", "messages[].content"), each=("$.messages", "role", "content")),
    Mapping("messages_id", ("conv_id", "messages[].role", "messages[].content"), each=("$.messages", "role", "content")),
    Mapping("from_value", ("conversations[].from", "conversations[].value"), each=("$.conversations", "from", "value")),
    Mapping("prompt_response", ("prompt", "response"), (("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("prompt_completion", ("prompt", "completion"), (("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("question_answer", ("question", "answer"), (("user", "$.question"), ("assistant", "$.answer"))),
    Mapping(
        "instruction_input", ("instruction", "input", "output"),
        (("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")), optional=("$.input",),
    ),
    Mapping("instruction", ("instruction", "output"), (("user", "$.instruction"), ("assistant", "$.output"))),
    Mapping(
        "system_prompt", ("system", "prompt", "response"),
        (("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response")), optional=("$.system",),
    ),
)


def _shape(fields: tuple[str, ...]) -> str:
    """The shape text of a set of paths, as `shape` computes it from a record."""
    tree: dict = {}
    for path in fields:
        at = tree
        parts = path.split(".")
        for i, p in enumerate(parts):
            at = at.setdefault(p, {} if i + 1 < len(parts) else None)

    def text(node: dict) -> str:
        inner = []
        for name in sorted(node, key=lambda n: n.removesuffix("[]")):
            child = text(node[name]) if node[name] else "*"
            inner.append(f"{name.removesuffix('[]')}:{f'[{child}]' if name.endswith('[]') else child}")
        return "{" + ",".join(inner) + "}"

    return text(tree)


def shape(record: Column) -> Column:
    """Nested field paths of a variant, in name order, without the values' types.

    Closing brackets of objects and arrays are alike: the opening ones tell them apart.
    """
    s = F.regexp_replace(F.schema_of_variant(record), SCALARS, "*")
    for old, new in (("OBJECT<", "{"), ("ARRAY<", "["), (": ", ":"), (", ", ",")):
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


def fingerprint(record: Column) -> Column:
    return F.sha2(shape(record), 256)


def fingerprint_of(fields: tuple[str, ...]) -> str:
    """The fingerprint of records with these paths."""
    return hashlib.sha256(re.sub(r"[\]}]", ">", _shape(fields)).encode()).hexdigest()


def _turns(m: Mapping, record: Column) -> Column:
    get = lambda path: F.try_variant_get(record, path, "string")
    named = lambda c: F.coalesce(_renamed(c), F.lit(""))
    if m.each:
        path, role, text = m.each
        rows = F.try_variant_get(record, path, f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(rows, lambda x: F.struct(named(x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")))
    turns = F.array(
        *[
            F.struct(
                (F.coalesce(get(role), F.lit("")) if role.startswith("$") else F.lit(role)).alias("role"),
                F.coalesce(get(path), F.lit("")).alias("text"),
                F.lit(path in m.optional).alias("optional"),
            )
            for role, path in m.turns
        ]
    )
    turns = F.filter(turns, lambda x: ~(x["optional"] & (x["text"] == "")))
    return F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))


def _renamed(role: Column) -> Column:
    out = role
    for old, new in ROLES.items():
        out = F.when(role == old, new).otherwise(out)
    return out


def canonical_turns(df: DataFrame, record_col: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds layout and turns to rows with a variant column.

    A record whose fingerprint is not registered, or that is null, gets the layout
    `unmapped` and null turns: it is reported, never guessed. A missing or null text
    is empty, as is a null role.
    """
    record = F.col(record_col)
    df = df.withColumn("_fp", fingerprint(record))
    layout = F.lit("unmapped")
    turns = F.lit(None).cast(TURNS)
    for m in mappings:
        hit = F.col("_fp") == F.lit(fingerprint_of(m.fields))
        layout = F.when(hit, m.name).otherwise(layout)
        turns = F.when(hit, _turns(m, record)).otherwise(turns)
    return df.withColumn("layout", layout).withColumn("turns", turns).drop("_fp")


def escape(c: Column) -> Column:
    """One more backslash between every `<` and `|`, so no control string is left."""
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    """Roles also stay on one line."""
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    one = F.regexp_replace(unescape(c), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(one, F.lit("\\\\"), F.lit("\\"))


def format_turns(turns: Column) -> Column:
    """Each turn as `<|im_start|>role\\ntext<|im_end|>\\n`, escaped."""
    parts = F.transform(
        turns, lambda t: F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(CLOSE + "\n"))
    )
    return F.concat_ws("", parts)


def _blocks(formatted: Column) -> Column:
    return F.filter(F.split(formatted, re.escape(OPEN), -1), lambda b: b != "")


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text, with the place of each escaped text: role, text, start (from 1), length.

    Places are running sums, kept in two levels: n turns go in about sqrt(n) runs, as every
    step of a sum copies the list it has made so far.
    """
    spans = "array<struct<role:string,start:bigint,length:bigint>>"
    read = lambda b, start: F.struct(
        unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        (start + F.lit(len(OPEN)) + F.instr(b, "\n")).cast("long").alias("start"),
        (F.length(b) - F.instr(b, "\n") - F.lit(len(CLOSE) + 1)).cast("long").alias("length"),
    )
    size = lambda b: (F.length(b) + F.lit(len(OPEN))).cast("bigint")
    begin = lambda at, kind: F.struct(at.cast("bigint").alias("at"), F.array().cast(kind).alias("out"))
    step = lambda acc, n, more: F.struct((acc["at"] + n).cast("bigint").alias("at"), F.concat(acc["out"], F.array(more)).alias("out"))

    def run(blocks: Column, at: Column) -> Column:
        return F.aggregate(blocks, begin(at, spans), lambda acc, b: step(acc, size(b), read(b, acc["at"])), lambda acc: acc["out"])

    def whole(blocks: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(blocks).cast("double"))).cast("int")
        runs = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.slice(blocks, i * width + 1, width))
        length = lambda r: F.aggregate(r, F.lit(0).cast("bigint"), lambda n, b: n + size(b))
        return F.aggregate(runs, begin(F.lit(1), f"array<{spans}>"), lambda acc, r: step(acc, length(r), run(r, acc["at"])), lambda acc: F.flatten(acc["out"]))

    # one transform binds the blocks, so they are split once
    return F.transform(F.array(_blocks(formatted)), lambda b: F.when(F.size(b) > 0, whole(b)).otherwise(F.array().cast(spans)))[0]


def format_conversations(records: DataFrame, id_col: str = "conv_id", order_col: str = "turn") -> DataFrame:
    """Format heterogeneous records: id, order, record (variant).

    Records with the same id are parts of one conversation, in order (nulls first,
    ties by their turns). Returns conv_id, formatted, spans (role, start from 1 and
    length of each text in the formatted one, read back from it) and layouts. Records
    of unknown layout add no turns and show as `unmapped` in layouts; an id of only such
    records has an empty text. Ids may be null (one conversation). An empty table gives
    an empty result; other columns are ignored. One conversation is one text, so its
    turns must meet in one row; nothing larger than a conversation does. The work grows
    with a conversation's characters and, slower than its square, with its turns.
    """
    turns = canonical_turns(records.select(F.col(id_col).alias("conv_id"), F.col(order_col).alias("ord"), "record"), "record")
    one = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("ord", F.coalesce("turns", F.array().cast(TURNS)).alias("turns")))).alias("parts"),
        F.array_sort(F.collect_set("layout")).alias("layouts"),
    )
    text = format_turns(F.flatten(F.transform("parts", lambda p: p["turns"])))
    out = one.select("conv_id", text.alias("formatted"), "layouts")
    return out.withColumn("spans", parse_turns(F.col("formatted")))


def read_back(df: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Adds turns (role, text) and loss (the texts under the loss mask), from formatted and spans.

    Each text is read from its turn's block, where its span ends before the closing string:
    a place counted from the text's beginning would be sought anew for every turn.
    """
    text = lambda b, s: unescape(F.substring(b, F.length(b) - s["length"].cast("int") - F.lit(len(CLOSE)), s["length"].cast("int")))
    both = F.zip_with("spans", _blocks(F.col("formatted")), lambda s, b: F.struct(s["role"].alias("role"), text(b, s).alias("text")))
    df = df.withColumn("turns", both)
    return df.withColumn("loss", F.transform(F.filter("turns", lambda t: t["role"] == loss_role), lambda t: t["text"]))
