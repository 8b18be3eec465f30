"""Confirmations carried out on a store."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarnlab.warehouse import confirm, ingest, registry
from tarnlab.warehouse.store import Store

DAY = dt.date(2024, 5, 7)


def at(hour):
    return dt.datetime(2024, 5, 7, hour)


@pytest.fixture
def store(spark, tmp_path):
    """Two points with their own names, three unknown names with samples, and what was measured."""
    out = Store(spark, f"file://{tmp_path}/store")
    ingest.ensure_schema(out)

    def add(table, *rows):
        for r in rows:
            df = registry._one(out, table, **r)
            parts = df if r is rows[0] else parts.union(df)  # noqa: F821
        out.append(table, parts, "me", "seed")

    add("feature", {"uuid": "f1", "name": "Site.P1", "site": "Site"}, {"uuid": "f2", "name": "Site.P2", "site": "Site"})
    pending = {"kind": "pending", "auto_assign": False, "n_seen": 1}
    add(
        "feature_alias", {"uuid": "own1", "uuid_feature": "f1", "alias_key": "site.p1", "name": "Site.P1", "kind": "self", "auto_assign": True},
        {"uuid": "a1", "alias_key": "pond", "name": "Pond", **pending}, {"uuid": "a2", "alias_key": "site.p1", "name": "SITE.P1", **pending}, {"uuid": "a3", "alias_key": "site.p2", "name": "Site.P2", **pending},
    )
    add(
        "sample", {"uuid": "s1", "uuid_feature_alias": "own1", "date": DAY, "datetime": at(8)}, {"uuid": "s2", "uuid_feature_alias": "a1", "date": DAY, "datetime": at(9)},
        {"uuid": "s3", "uuid_feature_alias": "a1", "date": dt.date(2024, 5, 8)}, {"uuid": "s4", "uuid_feature_alias": "a2", "date": dt.date(2024, 5, 9)}, {"uuid": "s5", "uuid_feature_alias": "a2", "date": dt.date(2024, 5, 9)},
    )
    add(
        "analysis", {"uuid": "x1", "uuid_sample": "s1", "uuid_lab": "m1", "value": 1.0, "quantified": True}, {"uuid": "x2", "uuid_sample": "s2", "uuid_lab": "m1", "value": 1.0, "quantified": True},
        {"uuid": "x3", "uuid_sample": "s1", "uuid_lab": "m2", "value": 2.0, "quantified": True}, {"uuid": "x4", "uuid_sample": "s2", "uuid_lab": "m2", "value": 500.0, "quantified": True},
        {"uuid": "x5", "uuid_sample": "s2", "uuid_lab": "m3", "value": 7.0, "quantified": True},
    )
    add("review_queue", {"uuid": "q1", "kind": "unknown_feature", "status": "open", "payload": '{"key":"pond"}'}, {"uuid": "q2", "kind": "unknown_feature", "status": "open", "uuid_target": "a2"}, {"uuid": "q3", "kind": "other", "status": "open", "uuid_target": "a2"})
    return out


def requests(store, *rows):
    return store.spark.createDataFrame(list(rows), "uuid_alias string, uuid_feature string")


def test_points_are_confirmed_and_their_samples_merged(store):
    both = requests(store, ("a1", "f1"), ("a2", "f1"), ("a3", "f2"))
    version = store.version
    with pytest.raises(ValueError, match="samples collide"):
        confirm.confirm_aliases(store, both, "me")
    assert store.version == version
    got = {r.uuid_alias: (r.action, r.n_samples) for r in confirm.confirm_aliases(store, both, "me", override=True).collect()}
    assert got == {"a1": ("merged", 2), "a2": ("self_arm", 2), "a3": ("confirmed", 0)} and store.version == version + 1
    alias = {r.uuid: (r.uuid_feature, r.kind, r.auto_assign) for r in store.read("feature_alias").collect()}
    assert alias == {"own1": ("f1", "self", True), "a1": ("f1", "transcription_error", True), "a3": ("f2", "self", True)}
    assert {r.uuid: r.uuid_feature_alias for r in store.read("sample").collect()} == {"s1": "own1", "s3": "a1", "s4": "own1", "s5": "own1"}
    assert {r.uuid: (r.uuid_sample, r.value) for r in store.read("analysis").collect()} == {"x1": ("s1", 1.0), "x3": ("s1", 2.0), "x4": ("s1", 500.0), "x5": ("s1", 7.0)}
    queue = {(r.kind, r.subkind, r.status, r.uuid_target) for r in store.read("review_queue").collect()}
    assert queue == {
        ("unknown_feature", None, "closed", None), ("unknown_feature", None, "closed", "own1"), ("other", None, "open", "own1"), ("value_conflict", "alias_merge", "open", None),
        ("sample_collision", "same_alias", "open", "own1"),
    }
    lost = store.read("change_log").where("action = 'provenance'").collect()
    assert [(r.uuid_row, r.field, r.old[:13], r.new[:13]) for r in lost] == [("s2", "datetime", "2024-05-07 09", "2024-05-07 08")]
    again = confirm.confirm_aliases(store, requests(store, ("a1", "f1")), "me")
    assert [r.action for r in again.collect()] == ["confirmed"]


def test_what_is_refused(store):
    make = store.spark.createDataFrame
    full = "uuid_alias string, uuid_feature string, kind string, date_start date, date_end date"
    version = store.version
    for rows, why in (
        ([("zz", "f1", None, None, None)], "no such alias"), ([("a1", "zz", None, None, None)], "no such point"), ([("a1", "f1", None, None, None), ("a1", "f2", None, None, None)], "twice"),
        ([("own1", "f2", None, None, None)], "another point"), ([("a2", "f1", None, DAY, None)], "no dates"), ([("a1", "f1", None, DAY, dt.date(2020, 1, 1))], "wrong way"),
        ([("a1", None, None, None, None)], "nothing to do"), ([("own1", None, None, DAY, None)], "no dates"), ([("a2", "f1", "descriptive", None, None)], "its kind"),
    ):
        with pytest.raises(ValueError, match=why):
            confirm.confirm_aliases(store, make(rows, full), "me")
    assert store.version == version
    out = confirm.confirm_aliases(store, make([("a1", None, None, DAY, None)], full), "me").collect()
    assert [(r.action, r.n_samples) for r in out] == [("bounds_updated", 2)]
    assert store.read("feature_alias").where("uuid = 'a1'").first().date_start == DAY


def test_chains_of_merges(store):
    moves = lambda *rows: store.spark.createDataFrame(list(rows), "old string, new string")
    chain = moves(*[(f"n{k:03d}", f"n{k + 1:03d}") for k in range(100)], ("m", "n050"))
    assert {r.new for r in confirm.closed(chain).collect()} == {"n100"}
    for bad in (moves(("a", "b"), ("b", "c"), ("c", "a")), moves(("a", "b"), ("a", "c")), moves(("a", "a")), moves(("a", "b"), ("b", "a"))):
        with pytest.raises(ValueError):
            confirm.closed(bad)
    got = {r.uuid: r.action for r in confirm.merge_samples(store, moves(("s2", "s3"), ("s3", "s1")), "me").collect()}
    assert got == {"x2": "drop_equal", "x4": "review", "x5": "repoint"}
    assert {r.uuid for r in store.read("sample").collect()} == {"s1", "s4", "s5"}
    with pytest.raises(ValueError, match="no such sample"):
        confirm.merge_samples(store, moves(("s4", "zz")), "me")


def test_methods_are_confirmed_and_values_converted(store):
    a = registry.add_analyte(store, "Lead", "me", "seed", units="mg/L")
    for uuid, unit in (("m2", "ug/L"), ("m3", "furlong")):
        store.append("lab_method", registry._one(store, "lab_method", uuid=uuid, name="Lead", method=uuid, organisation="ALS", units=unit), "me", "seed")
    registry.add_review(store, "unknown_analyte", "me", payload='{"key":"ALS|lead|m2"}')
    ask = store.spark.createDataFrame([("m2", a), ("m3", a)], "uuid_lab string, uuid_analyte string")
    got = {r.uuid_lab: (r.status, r.n_converted, r.n_unknown) for r in confirm.confirm_methods(store, ask, "me").collect()}
    assert got == {"m2": ("confirmed", 2, 0), "m3": ("confirmed", 0, 1)}
    assert {r.uuid: r.value for r in store.read("analysis").where("uuid_lab <> 'm1'").collect()} == {"x3": pytest.approx(0.002), "x4": pytest.approx(0.5), "x5": 7.0}
    asked = {(r.kind, r.status) for r in store.read("review_queue").where("kind in ('unknown_analyte', 'unknown_unit')").collect()}
    assert asked == {("unknown_analyte", "closed"), ("unknown_unit", "open")}
    again = {r.uuid_lab: (r.status, r.n_converted) for r in confirm.confirm_methods(store, ask, "me").collect()}
    assert again == {"m2": ("already_confirmed", 0), "m3": ("already_confirmed", 0)} and store.read("review_queue").where("kind = 'unknown_unit'").count() == 1
    b = registry.add_analyte(store, "Zinc", "me", "seed", units="mg/L")
    with pytest.raises(ValueError, match="can't be confirmed"):
        confirm.confirm_methods(store, store.spark.createDataFrame([("m2", b)], "uuid_lab string, uuid_analyte string"), "me")
    assert store.read("lab_method").where(F.col("uuid_analyte") == b).count() == 0
