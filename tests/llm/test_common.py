from collections import Counter

import pytest

from tarnlab.llm import common


@pytest.fixture
def sides(spark, monkeypatch):
    """A key with most rows, some with a few, one without a partner; and a null key."""
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 1000)
    left = [(1, i) for i in range(60)] + [(2, i) for i in range(5)] + [(k, 0) for k in range(3, 20)] + [(99, 1), (None, 7)]
    n = Counter(k for k, _ in left)
    right = [(k, f"v{k}", n[k]) for k in range(1, 22)]
    return spark.createDataFrame(left, "key long, v long").repartition(5), spark.createDataFrame(right, "key long, name string, rows long")


@pytest.mark.parametrize("how", [common.hot_join, common.hot_join_once, lambda a, b, k: common.salted_join(a, b, k)])
def test_joins_of_hot_keys(sides, how):
    rows, dim = sides
    plain = Counter(tuple(r) for r in rows.join(dim, "key").select("key", "v", "name").collect())
    got = how(rows, dim, "key").select("key", "v", "name").collect()
    assert Counter(tuple(r) for r in got) == plain


def test_no_hot_keys(sides, monkeypatch):
    rows, dim = sides
    monkeypatch.setattr(common, "HOT_ROWS", 1000)
    for how in (common.hot_join, common.hot_join_once, common.salted_join):
        assert how(rows, dim, "key").count() == 82
        assert how(rows.limit(0), dim, "key").count() == 0
        assert how(rows, dim.limit(0), "key").count() == 0


@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_rows_that_may_be_wanted(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    rows = spark.range(2000).selectExpr("id AS key", "CAST(id AS STRING) AS text")
    wanted = spark.range(0, 2000, 100).selectExpr("id AS key")
    got = {r.key for r in common.may_be_in(rows, wanted, ["key"]).collect()}
    assert set(range(0, 2000, 100)) <= got and (bits == 64 or len(got) < 60)
    assert common.may_be_in(rows, wanted.limit(0), ["key"]).count() == 0


def test_shared_folder(spark):
    assert common.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
