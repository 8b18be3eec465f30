"""What a reconciled batch moves: rows go to their visits and names, not to themselves by row number, and no task gets all of them."""

import contextlib
import re

from pyspark.sql import functions as F

from tarnlab.operators import reconcile, resolve
from tarnlab.plans import inventory
from tarnlab.plans.roles import Roles

DATA = "/root/testdata/sf0.001"


@contextlib.contextmanager
def plain(spark):
    """Every join shuffles, as with large tables."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def test_rows_are_not_moved_by_row(spark):
    with plain(spark):
        df = inventory.reconcile_event(Roles(spark, DATA))
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(row#" not in plan
    assert len(re.findall(r"hashpartitioning\(point#\d+, date#", plan)) == 1  # one move to the visits for all that is asked there


def test_lookups_leave_resolved_rows_where_they_are(spark):
    r = Roles(spark, DATA)
    names = r.feature_alias.where("kind = 'self' and date_start is null and date_end is null").select("name")
    rows = names.select(F.col("name").alias("row"), F.lit("e").alias("event"), F.lit(False).alias("orphan"), F.col("name").alias("raw"), F.lit("1995-01-01").cast("date").alias("day"), F.lit(1.0).alias("confidence"))
    with plain(spark):
        got = resolve.resolve_features(rows, r.feature_alias, r.feature).groupBy(F.spark_partition_id()).count().collect()
    assert len(got) > 1 and sum(g["count"] for g in got) == rows.count()


def test_visits_ask_once_for_both(spark):
    """with_stored gives what with_existing and twin_supersession give, null keys and instants too."""
    k = F.col("id")
    each = spark.range(400).select(
        F.concat(F.lit("u"), k.cast("string")).alias("uuid"), F.when(k % 11 != 0, F.concat(F.lit("p"), k % 7)).alias("point"), F.when(k % 13 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (k % 3).cast("int"))).alias("date"),
        F.when(k % 5 != 0, F.timestamp_seconds(k % 4)).cast("timestamp_ntz").alias("datetime"), F.when(k % 17 != 0, F.concat(F.lit("m"), k % 3)).alias("uuid_lab"), F.when(k % 19 != 0, F.concat(F.lit("a"), k % 5)).alias("uuid_analyte"),
        F.when(k % 23 == 0, None).when(k % 2 == 0, "als_lab").when(k % 3 == 0, "acirl_transcription").otherwise("field").alias("kind"), (k % 9).cast("double").alias("value"), F.lit(None).cast("string").alias("value_chr"), F.lit(True).alias("quantified"), F.lit(1).alias("revision"),
    )
    stored, rows = each.where(F.xxhash64("uuid") % 2 == 0), each.withColumnRenamed("uuid", "row")
    got = {x.row: (x.e_uuid, x.e_value, x.twin) for x in reconcile.with_stored(rows, stored).collect()}
    found = {x.row: (x.e_uuid, x.e_value) for x in reconcile.with_existing(rows, stored).collect()}
    twins = {x.row: x.twin for x in reconcile.twin_supersession(rows.select("row", "kind", "point", "date", "datetime", "uuid_analyte"), stored).collect()}
    assert got == {k: (*found[k], twins[k]) for k in found} and len(got) == 400
    assert any(v[0] for v in got.values()) and any(v[2] for v in got.values())


def test_a_crosstab_moves_once_and_is_not_written(spark, monkeypatch):
    """Orders' lines move by sheet before they become cells; every step on cells is a window there."""
    from tarnlab.operators import grids
    from tarnlab.plans import files

    monkeypatch.setattr(grids, "written", None, raising=False)  # fails if it is called
    with plain(spark):
        plan = files.unpivot_crosstab(Roles(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange \w+\(", plan)) == 1 and "explode" in plan[: plan.index("Exchange ")]


def test_a_crosstab_with_two_headers_and_late_labels(spark):
    """A section's columns come from its labels and headers wherever they stand; an earlier section's don't reach it."""
    from tarnlab.operators import grids

    sheet = {
        (1, 1): "Matrix: SOIL", (2, 2): "ALS Sample number:", (2, 5): "A1", (3, 1): "Analyte", (3, 2): "CAS Number", (3, 3): "Unit", (4, 1): "lead", (4, 5): "1",
        (5, 1): "Matrix: WATER", (6, 1): "Analyte", (6, 2): "CAS Number", (6, 3): "Unit", (7, 1): "EA1: metals", (8, 1): "zinc", (8, 3): "mg/L", (8, 4): "9", (8, 5): "2", (8, 6): "3",
        (9, 1): "Analyte", (9, 2): "CAS Number", (10, 2): "ALS Sample number:", (10, 5): "B1", (10, 6): "B2", (11, 2): "Client sample ID (1st):", (11, 6): "P",
    }
    c = spark.createDataFrame([("f", "s", r, k, v) for (r, k), v in sheet.items()], "file string, sheet string, r long, c int, v string")
    got = sorted((x.section, x.source_ref, x.analyte_raw, x.method_raw, x.units_raw, x.lab_sample_id, x.feature_raw, x.value_raw) for x in grids.unpivot_crosstab(c.repartition(3)).collect())
    assert got == [(1, "r4c5", "lead", None, None, "A1", None, "1"), (2, "r8c5", "zinc", "EA1: metals", "mg/L", "B1", None, "2"), (2, "r8c6", "zinc", "EA1: metals", "mg/L", "B2", "P", "3")]


def test_a_water_sheet_moves_once_and_is_not_written(spark, monkeypatch):
    """Orders' lines move by sheet; then lines of sheets meet the allowed labels, with their cells, and don't come back."""
    from tarnlab.operators import workbook

    monkeypatch.setattr(workbook, "written", None, raising=False)  # fails if it is called
    with plain(spark):
        plan = inventory.water_sheet(Roles(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange \w+\([^)]*file#", plan)) == 1 and "method_key" not in plan
    assert plan.count("/lineitem.parquet") == 1 and len(re.findall(r"Exchange ", plan)) <= 4  # lines by sheet, lines by label, labels once or twice


def test_water_sheets_with_dates_below_and_without_a_date(spark):
    """A date row below the header counts if none stands above; without one, results have no date; sheets don't mix."""
    from tarnlab.operators import workbook

    sheets = {
        "A": [["Site Name", "Units", "P1", "", "P2"], ["pH", "-", "7", "5", "6"], ["Sample date", "", "45802", "", ""], ["pH", "-", "--", "", "1"]],
        "B": [["", "Site Name", "Units", "Q"], ["", "pH", "", "x"]],
        "C": [["pH", "-", "7"]],
        "D": [["Date", "", "01/02/2025"], ["Site Name", "Units", "", "P"], ["pH", "", "3", "4"]],
    }
    c = spark.createDataFrame([("f", n, r, k, v) for n, rows in sheets.items() for r, row in enumerate(rows, 1) for k, v in enumerate(row, 1)], "file string, sheet string, r long, c int, v string")
    out = workbook.water_sheet(c.repartition(3), spark.createDataFrame([("ph",)], "key string")).collect()
    got = sorted(tuple(x or "" for x in (r.sheet, r.source_ref, r.kind, r.feature_raw, r.sample_date_raw, r.value_raw)) for r in out)
    assert got == [
        ("A", "r2c3", "result", "P1", "25/05/2025", "7"), ("A", "r2c5", "result", "P2", "25/05/2025", "6"), ("A", "r4c3", "not_analysed", "P1", "25/05/2025", "--"), ("A", "r4c5", "result", "P2", "25/05/2025", "1"),
        ("B", "r2c4", "result", "Q", "", "x"), ("C", "", "no_site_row", "", "", ""), ("D", "r3c4", "result", "P", "", "4"),
    ]
    assert [r.parsed for r in out if r.sheet == "C"] == [None]


def test_rows_meet_their_keys_spans_in_one_join(spark, monkeypatch):
    """Orders move by customer, then by key; only those whose key is known are written, and none is moved by key and day."""
    from tarnlab.plans import resolution

    seen, write = [], resolve.written

    def noted(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    for module in (resolve, resolution):
        monkeypatch.setattr(module, "written", noted)
    r = Roles(spark, DATA)
    with plain(spark):
        known = resolution.conditional_narrowing(r).select("row").distinct().count()
        assert [name for name, _ in seen] == ["alias-spans"]
        moved = re.findall(r"hashpartitioning\(([^)]*), \d+\)", seen[0][1])
    assert not [x for x in moved if "day#" in x or re.match(r"(concat\(s, |uuid#)", x)] and len([x for x in moved if x.startswith("o_custkey#")]) == 1
    assert 0 < known < r.sample.count()


def test_edges_of_a_key_are_each_day_once(spark):
    """However many aliases a key has, rows carry no more of it than its distinct bounds."""
    day = lambda c: F.col(c).cast("date").alias(c)
    feature = spark.sql("select 'f' as uuid, 'S' as site, date '2024-03-05' as date_end")
    alias = spark.range(3000).selectExpr("concat('x', id) as uuid", "'f' as uuid_feature", "if(id % 3 = 0, 'k', 'l') as alias_key", "'self' as kind", "true as auto_assign", "if(id % 2 = 0, '2024-03-01', null) as date_start", "'2024-03-03' as date_end")
    alias = alias.select("uuid", "uuid_feature", "alias_key", "kind", "auto_assign", day("date_start"), day("date_end"))
    got = {x.key: sorted(str(e) for e in x.edges if e) for x in resolve._edges(alias, feature).collect()}
    assert got == {k: ["2024-03-01", "2024-03-04", "2024-03-06"] for k in "kl"}
