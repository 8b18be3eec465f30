import hashlib
import random
import sys
import zlib
from functools import cache

import pytest
from pyspark.sql import types as T

from tarnlab.llm import repair

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("copies_", "free", "at", "stretch", "cost")]
)
sys.setrecursionlimit(20_000)
SPACE = " \t\n\x0b\x0c\r"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        if fault == 4:
            role = "user"
        if fault in (1, 2):
            text = "" if fault == 1 else text.translate(str.maketrans("", "", ".!?"))
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def cheapest(turns):
    """The least cost and audit by trying every edit: turns are (initial, fault)."""

    @cache
    def best(i, state, inserts):
        found = [(0, "")] if i == len(turns) and state in (0, 3) else []
        if inserts < 2:
            for x in "ua":
                if (state, x) in STEP:
                    cost, rest = best(i, STEP[state, x], inserts + 1)
                    found.append((cost + 5, "I" + rest))
        if i < len(turns):
            initial, fault = turns[i]
            cost, rest = best(i + 1, state, 0)
            found.append((cost + 2, "D" + rest))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for x, edit, price in ((initial, "K", 0), ("u", "R", 1), ("a", "R", 1)):
                    if (state, x) in STEP:
                        cost, rest = best(i + 1, STEP[state, x], 0)
                        found.append((cost + price + more, edit + rest))
        return min(found, default=(10**9, ""))

    return best(0, 0, 0)


def turns_of(rows, edits):
    out, rows, state = [], list(rows), 0
    for e in edits:
        role, text = (None, "") if e == "I" else rows.pop(0)[2:]
        if e == "D":
            continue
        if e in "IR":
            role = "assistant" if state == 2 else "user"
        state = STEP[state, role[:1]]
        out.append((role, text))
    return out


def expected(rows):
    """Row by row."""
    after, out = damaged(rows), {}
    for conv in {r[0] for r in rows}:
        mine = sorted([r for r in after if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = text.rstrip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[2][:1] for r in mine]
        known = {r[1] for r in mine} - {None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = cheapest(tuple(zip(initials, faults, strict=True)))
        turns = turns_of(mine, audit)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def conversation(rng, conv, n):
    says = ["One. ", "Two!", "Why?\n", "so", "", " \t", None, "Well done.", "a.b", "?", "\xa0"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "User", "s"]
    texts = [rng.choice(says) if rng.random() < 0.4 else f"Line {rng.randrange(10**6)}." for _ in range(n)]
    return [(conv, rng.choice([k, k, k, k, None, rng.randrange(n)]), rng.choice(roles[: rng.choice((2, 5, 10))]), t) for k, t in enumerate(texts)]


def reported(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(5)
    report, turns = repair.repair(repair.damage(df), **options)
    got = report.collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}, turns


def test_against_every_edit(spark):
    rng = random.Random(5)
    rows = [r for conv in [*range(150), None] for r in conversation(rng, conv, rng.randrange(1, 14))]
    rows += rng.sample(rows, 60)
    got, turns = reported(spark, rows)
    assert got == expected(rows)
    for r in turns.collect():
        roles = [t.role for t in r.turns]
        assert all(x in ("user", "assistant") or x.startswith(("s", "u", "a")) for x in roles)


@pytest.mark.parametrize("rows_each", [1, 7])
def test_one_conversation_over_many_stretches(spark, rows_each):
    rng = random.Random(rows_each)
    rows = conversation(rng, 1, 300) + conversation(rng, 2, 40) + conversation(rng, 0, 90)
    rows += [(1, 400, "user", "The same.")] * 50
    got, _ = reported(spark, rows, stretch_rows=rows_each)
    assert got == expected(rows)


def test_solve_and_ties():
    keep = lambda s: [(i, 1, True, False) for i in s]
    costs, audits = repair.solve(keep("sua"), repair.NONE)
    assert (costs[repair.ASSISTANT], audits[repair.ASSISTANT]) == (0, "KKK")
    # of two users in a row the first goes, as D is before K
    costs, audits = repair.solve(keep("uua"), repair.NONE)
    assert (costs[repair.ASSISTANT], audits[repair.ASSISTANT]) == (2, "DKK")
    # a lone user turn: deleting costs less than an answer
    costs, audits = repair.solve(keep("u"), repair.NONE)
    assert costs[:3] == [2, None, 0] and audits[0] == "D"


def test_empty_and_dropped(spark):
    report, turns = repair.repair(repair.damage(spark.createDataFrame([], SCHEMA)))
    assert report.count() == 0 and turns.count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    got, _ = reported(spark, [(7, dropped, "user", "Hello.")])
    assert got == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_undamaged_rows(spark):
    rows = spark.createDataFrame([(1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (2, 1, "assistant", "Yes.")], "conv_id long, turn int, role string, text string")
    report, turns = repair.repair(rows)
    got = {r.conv_id: (r.cost, r.audit) for r in report.collect()}
    assert got == {1: (0, "KK"), 2: (2, "D")}
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in turns.collect()} == {1: [("user", "Hi."), ("assistant", "Yes.")], 2: []}
