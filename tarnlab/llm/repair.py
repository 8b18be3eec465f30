"""Structure repair of conversations by a retained-subsequence dynamic programme.

Turns are kept, given another role or deleted, and empty turns inserted, at the least
cost, so that roles follow `(s?(ua)+)?` (system, user, assistant). The programme chooses
the turns to retain and their roles: what lies between two of them is deleted at a price
from prefix sums, so each state (the last retained role) needs but a running minimum, and
turns that must go only move the sums; the two roles alone say what to insert between them.
Equal costs are told apart by the audits, the strings of edits, whose order ranks carry along.

A conversation may be longer than a task should hold. Rows are sorted over all partitions
by conversation and turn, and cut into stretches; each stretch is solved for every role that
may come before it, stretches are chained by those results, and each then writes its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common

#: Costs of edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows and characters of one stretch.
STRETCH_ROWS, STRETCH_CHARS = 4096, 1 << 20
#: Stretches or conversations of one batch.
BATCH_ROWS = 32

#: White space, what ends a sentence, and the states (nothing retained yet, then the last retained role).
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = ("su", "ua", "au")
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Inserted turns between a state and a retained user or assistant turn, and behind the last.
BETWEEN = {(r, x): int((r == USER) == (x == USER)) for r in range(4) for x in (USER, ASSISTANT)}
BEHIND = {NONE: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}


def damage(rows: DataFrame) -> DataFrame:
    """The rows of a table of conversations (conv_id, turn, role, text; nulls of role and text: one
    space) with faults that a checksum of conversation and turn decides, and `copies`, how often each stands there."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, f"[{ENDS}]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _bare(text: Column) -> Column:
    """text without the white space at its end."""
    return F.rtrim(text, F.lit(SPACE))


def faults(rows: DataFrame) -> DataFrame:
    """rows (different ones, with copies) and how many copies are blank or duplicate; `free` is one that need not go.

    A row repeats what stands earlier in its conversation with the same role and text: in
    the same turn as a copy, or in a turn before. The first turns are aggregated for each
    text, so no group of copies meets in one task.
    """
    part = lambda c: F.concat(F.length(c).cast("string"), F.lit(":"), c)
    said = F.concat(part(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))), part(F.col("role")), "text")
    keyed = rows.withColumn("_said", F.sha1(said))
    first = keyed.groupBy("_said").agg(F.min(F.struct("turn")).alias("_first"), F.count("*").alias("rows"))
    marked = common.hot_join(keyed, common.materialize(first, "repair-first"), "_said", drop="rows")
    blank = _bare(F.col("text")) == ""
    repeats = ~F.struct("turn").eqNullSafe(F.col("_first"))
    truncated = ~F.substring(_bare(F.col("text")), -1, 1).isin(*ENDS)
    free = ~blank & ~repeats
    return marked.select(
        "conv_id", "turn", "role", "text", "copies", free.alias("free"), blank.alias("blank"), (free & truncated).alias("truncated"),
    )


def solve(rows: list[tuple[str, int, bool, bool]], entry: int) -> tuple[list[int | None], list[str | None]]:
    """The least cost and the least audit from one state to every state, None where there is no way.

    rows: role initial, copies, free, truncated; all copies but the first of a free row must go.
    """
    best: list[int | None] = [None] * 4  # running minima, less the price of deleting all rows so far
    best[entry] = 0
    rank = [0] * 4  # the order of the states' audits
    deleted = 0  # prefix sum of deletions
    back = []
    for initial, copies, free, truncated in rows:
        if not free:
            deleted += DELETE * copies
            back.append(None)
            continue
        now, how = [None] * 4, [None] * 4
        for x in range(4):
            ways = [] if best[x] is None else [(best[x], rank[x], "D", x)]
            same = STATES.get(initial) == x
            price = (0 if same else REROLE) + (TRUNCATED if truncated else 0) - DELETE
            if x in NAMES:
                edit = "K" if same else "R"
                ways += [(best[r] + INSERT * BETWEEN[r, x] + price, rank[r], "I" * BETWEEN[r, x] + edit, r) for r in range(4) if best[r] is not None]
            elif x == SYSTEM and same and best[NONE] is not None:
                ways.append((best[NONE] + price, rank[NONE], "K", NONE))
            if ways:
                way = min(ways)
                now[x], how[x] = way[0], way[1:]
        order = sorted((how[x][:2], x) for x in range(4) if how[x])
        for k, (_, x) in enumerate(order):
            rank[x] = k
        best = now
        deleted += DELETE * copies
        back.append(how)
    costs = [None if b is None else b + deleted for b in best]
    audits: list[str | None] = []
    for x in range(4):
        if best[x] is None:
            audits.append(None)
            continue
        out, at = [], x
        for (_, copies, _, _), how in zip(reversed(rows), reversed(back), strict=True):
            if how is None:
                out.append("D" * copies)
            else:
                out.append(how[at][1] + "D" * (copies - 1))
                at = how[at][2]
        audits.append("".join(reversed(out)))
    return costs, audits


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches, one after the other."""
    for batch in batches:
        yield from batch.to_pylist()


def _rows_of(made, schema: T.StructType):
    """A function over batches from one that gives rows: few rows a batch, as they may be long."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = made(batches)
        while some := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_pylist(some, schema=arrow)

    return run


TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _stretch_schema(rows: DataFrame) -> T.StructType:
    long = T.LongType()
    held = T.StructType([T.StructField("copies", long), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    fields = [T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("stretch", long), *(T.StructField(c, long) for c in COUNTS)]
    fields += [T.StructField("first", T.StringType()), T.StructField("last", T.StringType())]
    fields += [T.StructField("costs", T.ArrayType(T.ArrayType(long))), T.StructField("audits", T.ArrayType(T.ArrayType(T.StringType())))]
    return T.StructType([*fields, T.StructField("rows", T.ArrayType(held))])


def _stretch(rows: list[dict], fresh: bool) -> dict:
    """What a stretch's rows cost and count. fresh: it begins its conversation."""
    work = [(r["role"][:1], r["copies"], r["free"], r["truncated"]) for r in rows]
    solved = [solve(work, e) if e == NONE or not fresh else ([None] * 4, [None] * 4) for e in range(4)]
    pairs = sum((c - 1) * (2 * i not in LEGAL) for i, c, _, _ in work) + sum(a[0] + b[0] not in LEGAL for a, b in zip(work, work[1:], strict=False))
    return {
        "conv_id": rows[0]["conv_id"],
        "stretch": rows[0]["at"],
        "blank": sum(r["copies"] for r in rows if r["blank"]),
        "duplicate": sum(r["copies"] - r["free"] for r in rows if not r["blank"]),
        "truncated": sum(r["truncated"] for r in rows),
        "illegal": pairs,
        "first": work[0][0],
        "last": work[-1][0],
        "costs": [s[0] for s in solved],
        "audits": [s[1] for s in solved],
        "rows": [{"copies": r["copies"], "role": r["role"], "text": r["text"] if r["free"] else None} for r in rows],
    }


def stretches(marked: DataFrame, most: int = STRETCH_ROWS) -> DataFrame:
    """The rows of faults() in order of conversation, turn, role and text, cut into solved stretches; a written table.

    `stretch` numbers them in that order. All rows are sorted by ranges, so a long conversation
    lies on several partitions.
    """
    order = ["conv_id", "turn", "role", "text"]
    schema = _stretch_schema(marked)
    placed = marked.repartitionByRange(*order[:3], F.substring("text", 1, 64)).sortWithinPartitions(*order)
    placed = placed.withColumn("at", F.monotonically_increasing_id())
    common.small_batches(marked.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[dict] = []
        chars, whole = 0, False  # whole: held begins its conversation, as another stands before it here
        for row in _each(batches):
            new = bool(held) and row["conv_id"] != held[-1]["conv_id"]
            if new or len(held) >= most or chars >= STRETCH_CHARS:
                yield _stretch(held, whole)
                held, chars, whole = [], 0, new
            held.append(row)
            chars += len(row["text"])
        if held:
            yield _stretch(held, whole)

    return common.materialize(placed.mapInArrow(_rows_of(cut, schema), schema), "repair-stretches")


def _chain(parts: list[dict]) -> dict:
    """The best way through a conversation's stretches: cost, audit, counts and each stretch's states."""
    cost: list[int | None] = [0, None, None, None]
    rank, back = [0] * 4, []
    for p in parts:
        now, how = [None] * 4, [None] * 4
        for x in range(4):
            ways = [(cost[e] + p["costs"][e][x], rank[e], e) for e in range(4) if cost[e] is not None and p["costs"][e][x] is not None]
            if ways:
                now[x], _, how[x] = min(ways)
        order = sorted((rank[how[x]], p["audits"][how[x]][x], x) for x in range(4) if how[x] is not None)
        for k, (_, _, x) in enumerate(order):
            rank[x] = k
        cost = now
        back.append(how)
    least, _, at = min((cost[x] + INSERT * BEHIND[x], rank[x], x) for x in range(4) if cost[x] is not None)
    tail = BEHIND[at]
    states = []
    for how in reversed(back):
        states.append((how[at], at))
        at = how[at]
    states.reverse()
    audits = [p["audits"][e][x] for p, (e, x) in zip(parts, states, strict=True)]
    audits[-1] += "I" * tail
    counts = {c: sum(p[c] for p in parts) for c in COUNTS}
    counts["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
    ways = [{"stretch": p["stretch"], "entry": e, "edits": a} for p, (e, _), a in zip(parts, states, audits, strict=True)]
    return {"conv_id": parts[0]["conv_id"], "cost": least, "audit": "".join(audits), **counts, "ways": ways}


def chains(solved: DataFrame) -> DataFrame:
    """One row for each conversation: cost, audit, counts, and `ways`, the edits of each stretch; a written table.

    A conversation's stretches, without their texts, meet in order; its audit is one value of the
    result, a letter for each turn, so that much of it must fit a task.
    """
    long, text = T.LongType(), T.StringType()
    way = T.StructType([T.StructField("stretch", long), T.StructField("entry", long), T.StructField("edits", text)])
    fields = [solved.schema["conv_id"], T.StructField("cost", long), T.StructField("audit", text), *(T.StructField(c, long) for c in COUNTS)]
    schema = T.StructType([*fields, T.StructField("ways", T.ArrayType(way))])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, parts in groupby(_each(batches), key=lambda r: r["conv_id"]):
            yield _chain(list(parts))

    met = solved.drop("rows").repartition("conv_id").sortWithinPartitions("conv_id", "stretch")
    return common.materialize(met.mapInArrow(_rows_of(chained, schema), schema), "repair-chains")


def _applied(rows: list[dict], entry: int, edits: str) -> list[dict]:
    out, state, at = [], entry, 0

    def added(text: str):
        nonlocal state
        state = ASSISTANT if state == USER else USER
        out.append({"role": NAMES[state], "text": text})

    for r in rows:
        while edits[at] == "I":
            added("")
            at += 1
        if edits[at] == "K":
            out.append({"role": r["role"], "text": r["text"]})
            state = STATES[r["role"][:1]]
        elif edits[at] == "R":
            added(r["text"])
        at += r["copies"]
    for _ in edits[at:]:
        added("")
    return out


def repaired_turns(solved: DataFrame, chained: DataFrame) -> DataFrame:
    """The turns that stand after the repair: conv_id, stretch (in order) and its turns (role, text)."""
    schema = T.StructType([solved.schema["conv_id"], T.StructField("stretch", T.LongType()), T.StructField("turns", T.ArrayType(TURN))])

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in _each(batches):
            yield {"conv_id": row["conv_id"], "stretch": row["stretch"], "turns": _applied(row["rows"], row["entry"], row["edits"])}

    ways = chained.select(F.inline("ways"))
    return solved.select("conv_id", "stretch", "rows").join(ways, "stretch").mapInArrow(_rows_of(applied, schema), schema)


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's turns, `role:text` joined by newlines; they pass in order and none is held."""
    schema = T.StructType([turns.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, parts in groupby(_each(batches), key=lambda r: r["conv_id"]):
            h, between = hashlib.sha256(), b""
            for p in parts:
                for t in p["turns"]:
                    h.update(between + f"{t['role']}:{t['text']}".encode())
                    between = b"\n"
            yield {"conv_id": conv, "repaired_sha256": h.hexdigest()}

    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "stretch").mapInArrow(_rows_of(hashed, schema), schema)


def repair(rows: DataFrame, stretch_rows: int = STRETCH_ROWS) -> tuple[DataFrame, DataFrame]:
    """Repair conversations: a report of each, and the turns that stand (as repaired_turns() gives them).

    rows: conv_id, turn, role, text, and optionally copies (0: the row only says that there is
    such a conversation); other columns are ignored. Rows are taken by turn, nulls first, ties by
    role and text; rows alike in all count as that many. Null roles and texts are one space; conv_id
    may be null and is then a conversation too.

    The report: conv_id, gaps (turn numbers missing between the least and the greatest),
    blank, duplicate, truncated (rows by their first fault), illegal (neighbours whose
    role initials aren't su, ua or au), cost, audit (the edits' initials; of equal cost the
    least string), repaired_sha256. A conversation without rows has zeros, an empty audit and
    the digest of nothing. No rows give no conversations.
    """
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1).cast("long")
    one_space = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    each = rows.select("conv_id", "turn", *one_space, copies.alias("copies"))
    each = common.materialize(each.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "repair-rows")
    turn = F.when(F.col("copies") > 0, F.col("turn"))
    spans = each.groupBy("conv_id").agg((F.max(turn) - F.min(turn) + 1 - F.countDistinct(turn)).alias("gaps"))
    solved = stretches(faults(each.where("copies > 0")), stretch_rows)
    chained = chains(solved)
    turns = repaired_turns(solved, chained)
    found = chained.drop("ways").withColumnRenamed("conv_id", "_c").join(
        digests(turns).withColumnRenamed("conv_id", "_d"), F.col("_c").eqNullSafe(F.col("_d"))
    )
    out = spans.join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    report = out.select(
        "conv_id", *[number(c) for c in ("gaps", *COUNTS, "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
    return report, turns
