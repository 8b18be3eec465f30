"""Identity of samples against taking rows one by one."""

import datetime as dt
import random

from tarnlab.operators import samples

SCHEMA = "point string, date date, datetime timestamp_ntz"


def one(have, at):
    """The rule for one row: verdict and the sample, among (id, instant)."""
    if not have:
        return "create", None
    same = [h for h in have if at is not None and h[1] == at]
    if at is not None and not same and all(h[1] is not None for h in have):
        return "create", None
    left = same or have
    return ("refuse", None) if len(left) > 1 else ("reuse", left[0][0])


def instants(rng, n):
    day = dt.datetime(2024, 5, 7)
    return [rng.choice([None, day, day + dt.timedelta(hours=8), day + dt.timedelta(hours=9)]) for _ in range(n)]


def groups(seed, n):
    rng = random.Random(seed)
    stored, rows = [], []
    for g in range(n):
        place = (f"p{g}", dt.date(2024, 5, 7 + g % 5))
        stored += [(f"{g}-{k}", *place, at) for k, at in enumerate(instants(rng, rng.choice((0, 0, 1, 1, 2, 3))))]
        rows += [(f"{g:04d}-{k}", *place, at) for k, at in enumerate(instants(rng, rng.randrange(1, 6)))]
    return stored, rows


def test_batches_of_rows_one_by_one(spark):
    stored, rows = groups(1, 1000)
    expected, have = {}, {}
    for uuid, point, date, at in stored:
        have.setdefault((point, date), []).append((uuid, at))
    decided = {}
    for row, point, date, at in rows:
        if (point, date, at) in decided:
            expected[row] = decided[point, date, at]
            continue
        here = have.setdefault((point, date), [])
        verdict, uuid = one(here, at)
        if verdict == "create":
            uuid = f"new {row}"
            here.append((uuid, at))
        expected[row] = decided[point, date, at] = uuid
    df = spark.createDataFrame(rows, f"row string, {SCHEMA}")
    got = {r.row: r for r in samples.assigned(df, spark.createDataFrame(stored, f"uuid string, {SCHEMA}")).collect()}
    assert len(got) == len(rows)
    names = {}
    for row, want in expected.items():
        found = got[row].uuid_sample
        if want is None:
            assert (got[row].verdict, found) == ("refuse", None)
        elif want.startswith("new "):
            assert found.startswith("s-") and names.setdefault(want, found) == found
        else:
            assert found == want
    assert len(set(names.values())) == len(names)


def test_rows_alone(spark):
    stored, rows = groups(2, 300)
    have = {}
    for uuid, point, date, at in stored:
        have.setdefault((point, date), []).append((uuid, at))
    rows += [("null point", None, dt.date(2024, 5, 7), None), ("null day", "p1", None, None)]
    got = samples.existing(spark.createDataFrame(rows, f"row string, {SCHEMA}"), spark.createDataFrame(stored, f"uuid string, {SCHEMA}"))
    expected = {row: one(have.get((point, date), []), at) for row, point, date, at in rows}
    assert {r.row: (r.verdict, r.uuid_sample) for r in got.collect()} == expected
    none = spark.createDataFrame([], f"row string, {SCHEMA}")
    assert samples.assigned(none, spark.createDataFrame(stored, f"uuid string, {SCHEMA}")).count() == 0


def test_places_come_with_the_samples(spark):
    stored, rows = groups(2, 3)
    df, have = spark.createDataFrame(rows, f"row string, {SCHEMA}"), spark.createDataFrame(stored, f"uuid string, {SCHEMA}")
    out = samples.assigned(df, have)
    assert sorted((r.row, r.point, r.date) for r in out.collect()) == sorted(r[:3] for r in rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3  # two facts about stored samples and the way back to rows
