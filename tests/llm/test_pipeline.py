import glob
import os

import duckdb
import pytest

import corpus_pipeline
from tarnlab.llm import common, langid, packing, queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


def test_stages(spark):
    """Each stage against a plain restatement of its rule on what it was given."""
    docs = common.table(spark, DATA, "documents")
    columns = docs.columns
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.materialize(stage(spark, docs, DATA), f"test-{name}")
        tables[name] = (before.toPandas(), docs.toPandas())
        assert docs.columns == columns or name == "packing"

    a, b = tables["quality_rules"]
    verdict = queries.op2_quality_rules(spark, DATA).toPandas()
    assert set(b.doc_id) == set(verdict[verdict.kept].doc_id) and 0 < len(b) < len(a)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").toPandas()
    failed = set(verdict[verdict.base_failed].doc_id)
    assert set(labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id) - failed <= set(b.doc_id)

    a, b = tables["language_id"]
    assert set(b.doc_id) == set(a.doc_id)  # all have a clear language

    from test_jaccard import brute

    a, b = tables["near_duplicates"]
    classes = brute(list(zip(a.doc_id, a.text, strict=True)))
    assert sorted(b.doc_id) == sorted({c for _, _, c in classes})

    from test_substrings import brute as cut

    a, b = tables["repeated_passages"]
    expected = {i: t[0] for i, t in cut(list(zip(a.doc_id, a.text, strict=True))).items() if t[0].strip()}
    assert dict(zip(b.doc_id, b.text, strict=True)) == expected
    assert (b.text.str.len() == b.n_chars).all()

    a, b = tables["packing"]
    tokens = b.groupby("doc_id").length.sum()
    own = packing.WordTokenizer(queries.WORD_BPE)
    assert tokens.to_dict() == {i: len(own(t)) // 4 + 1 for i, t in zip(a.doc_id, a.text, strict=True)}
    assert langid.UNKNOWN not in set(a.lang)


def test_run(spark):
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns[:2] == ["doc_id", "start"] and got.count() > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(map(tuple, df.select(*columns).collect()), key=repr)
    assert got == sorted(con.sql(queries.oracle_sql()[name]).select(*columns).fetchall(), key=repr)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, docs, no_docs, name, stage):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns, and no rows at all."""
    from conftest_llm import documents

    got = stage(spark, docs, DATA)
    empty = stage(spark, no_docs, DATA)
    assert empty.count() == 0
    if name == "packing":
        assert {r.doc_id for r in got.collect()} == {i for i, _ in documents()}
        return
    assert got.columns == docs.columns == empty.columns
    rows, before = [tuple(r) for r in got.collect()], {tuple(r) for r in docs.collect()}
    if name != "repeated_passages":
        assert rows and set(rows) <= before
    ids = [r[0] for r in rows]
    if name == "quality_rules":
        assert not {12, 13, 14, 15} & set(ids) and 31 in ids
    if name == "language_id":
        assert not {12, 13, 14, 33} & set(ids) and ids.count(11) == 2
    if name == "near_duplicates":
        assert ids.count(11) <= 1 and 10 not in ids and 16 not in ids and {2, 12, 13, 14, 31} <= set(ids)
        assert ids.count(None) == 1  # the copy of 2 without an id went, the null text stayed
    if name == "repeated_passages":
        assert ids.count(11) == 2 and {12, 13, 14, 30, 31} <= set(ids)


def test_stages_without_labels(spark, no_docs, docs):
    assert dict(corpus_pipeline.STAGES)["language_id"](spark, docs.withColumn("lang", common.F.lit(None).cast("string")), DATA).count() == 0
