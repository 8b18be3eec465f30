"""Operators on small tables, against plain restatements of their rules."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tarnlab.operators import assemble, commit, grids, reconcile, registry, resolve, reviews, statistics


def test_batch_duplicates_match_the_greedy_rule(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for g in range(300):
        kept = []
        for pos in range(rng.randrange(1, 7)):
            at = rng.choice([None, None, 1, 2, 3])
            rows.append((g, pos, at))
            same = next((k for k, t in kept if t is None or at is None or t == at), None)
            expected[g, pos] = same
            if same is None:
                kept.append((pos, at))
    df = spark.createDataFrame(rows, "g int, pos int, datetime int")
    got = {(r.g, r.pos): r.duplicate_of for r in reconcile.batch_duplicates(df, ["g"]).collect()}
    assert got == expected


def test_batch_duplicates_keep_rows_without_key(spark):
    df = spark.createDataFrame([(None, 0, 1), (None, 1, 1)], "g int, pos int, datetime int")
    assert [r.duplicate_of for r in reconcile.batch_duplicates(df, ["g"]).collect()] == [None, None]


def _best(at, candidates):
    """Of (uuid, instant) pairs the one that a row at an instant matches."""
    if not candidates or all(at is not None and t is not None and t != at for _, t in candidates):
        return None
    return min(candidates, key=lambda c: (not (at is not None and c[1] == at), c[0]))[0]


def test_existing_match_by_instant(spark):
    rng = random.Random(11)
    stored = [(f"u{i:03}", rng.choice(["p", "q", "r", None]), rng.choice([1, 2, None]), rng.choice([1, 2, 3, 4, 5, None]), rng.choice(["m", "n"]), float(i), None, True, 1) for i in range(60)]
    stored += [(f"v{i}", "timed", 1, i % 3, "m", float(i), None, True, 1) for i in range(6)]
    rows = [(i, p, d, t, m) for i, (p, d, t, m) in enumerate((p, d, t, m) for p in ("p", "q", "s", "timed", None) for d in (1, 2, None) for t in (1, 2, 9, None) for m in ("m", "n", None))]
    columns = "uuid string, point string, date int, datetime int, uuid_lab string, value double, value_chr string, quantified boolean, revision int"
    known = spark.createDataFrame(stored, columns)
    asked = spark.createDataFrame(rows, "row int, point string, date int, datetime int, uuid_lab string")
    expected = {}
    for i, *key, at, m in rows:
        expected[i] = _best(at, [(u, t) for u, p, d, t, lab, *_ in stored if None not in (*key, m) and [p, d, lab] == [*key, m]])
    got = {r.row: r for r in reconcile.with_existing(asked, known).collect()}
    assert {i: r.e_uuid for i, r in got.items()} == expected
    value = {u[0]: u[5] for u in stored}
    assert all(r.e_value == value.get(r.e_uuid) for r in got.values())
    only = {r.row: r.e_uuid for r in reconcile.existing_match(asked, known).collect()}
    assert only == {i: u for i, u in expected.items() if u}
    assert reconcile.with_existing(asked, known.limit(0)).where("e_uuid is not null").isEmpty()


def test_existing_match_of_one_large_group(spark):
    """A visit with 200,000 rows on each side: pairs would be 4 * 10^10."""
    n = 200_000
    side = lambda c: spark.range(n).select(c, F.lit("p").alias("point"), F.lit(1).alias("date"), F.col("id").alias("datetime"), F.lit("m").alias("uuid_lab"))
    known = side(F.format_string("u%06d", "id").alias("uuid")).selectExpr("*", "1D value", "string(null) value_chr", "true quantified", "1 revision")
    found = reconcile.with_existing(side(F.format_string("u%06d", "id").alias("row")), known)
    assert found.where("row = e_uuid").count() == n


def test_twins_on_opposite_sides(spark):
    rng = random.Random(12)
    kinds, columns = ["als_lab", "acirl_transcription", "other", None], "kind string, point string, date int, datetime int, uuid_analyte string"
    make = lambda i: (i, rng.choice(kinds), rng.choice("pq"), rng.choice([1, 2]), rng.choice([1, 2, 3, None]), rng.choice(["a", None]))
    stored, rows = [make(f"u{i:02}") for i in range(30)], [make(i) for i in range(60)]
    opposite = {"als_lab": "acirl_transcription", "acirl_transcription": "als_lab"}
    expected = {}
    for i, kind, p, d, at, a in rows:
        twin = _best(at, [(u, t) for u, k, q, e, t, b in stored if kind in opposite and k == opposite[kind] and (p, d) == (q, e) and a is not None and a == b])
        expected[i] = (twin, "none" if twin is None else "skip" if kind == "acirl_transcription" else "delete_twin")
    got = reconcile.twin_supersession(spark.createDataFrame(rows, "row int, " + columns), spark.createDataFrame(stored, "uuid string, " + columns))
    assert {r.row: (r.twin, r.action) for r in got.collect()} == expected


def test_bounds_of_pending_aliases(spark):
    """New aliases hold from their first date, whatever the order of rows; stored bounds stay, even those that are open."""
    day = lambda n: dt.date(2024, 5, n)
    rows = [("new", "New", day(9), None), ("new", "New", day(3), 1), ("new", "New", None, None), ("dated", "D", day(1), None), ("open", "O", day(1), None), ("undated", "U", None, None)]
    stored = [("a1", None, "dated", 1, day(4)), ("a2", None, "open", 5, None), ("a3", "f", "new", 7, day(1))]
    pending = spark.createDataFrame(rows, "alias_key string, name string, date date, datetime int")
    alias = spark.createDataFrame(stored, "uuid string, uuid_feature string, alias_key string, n_seen int, date_start date")
    for order in (pending, pending.orderBy(F.desc("date"))):
        got = {r.alias_key: (r.date_start, r.n_seen, r.is_new) for r in commit.materialise_aliases(order, alias).collect()}
        assert got == {"new": (day(3), 3, True), "dated": (day(4), 2, False), "open": (None, 6, False), "undated": (None, 1, True)}


def test_units_sightings(spark):
    rows = [("b", "m1", "ug/L", "h2"), ("a", "m1", "mg/L", "h1"), ("a", "m2", "g/L", "h3"), ("b", "m2", "mg/L", "h4"), ("a", "m3", None, "h5"), ("a", "m4", "mg/L", "h6"), ("a", None, "mg/L", "h7"), ("a", "m5", "mg/L", "h8")]
    method = [("m1", None, "mg/L"), ("m2", None, "mg/L"), ("m3", None, "mg/L"), ("m4", None, None), ("m5", "known", "ug/L")]
    seen = commit.units_sightings(spark.createDataFrame(rows, "row string, uuid_lab string, units_raw string, source_hash string"), spark.createDataFrame(method, "uuid string, uuid_analyte string, units string"))
    assert sorted(tuple(r) for r in seen.collect()) == [("m2", "units", "mg/L", "g/L", "h3"), ("m4", "units", None, "mg/L", "h6")]


def test_compliance_flags(spark):
    rows = [("p", "a", 1.0, True), ("p", "b", 1.0, False), ("p", "c", 5.0, True), ("q", "a", None, None), ("q", "b", 2.0, True)]
    df = spark.createDataFrame(rows, "k string, sample string, value double, is_nd boolean")
    got = {r.k: r for r in statistics.compliance(df, ["k"]).collect()}
    p, q = got["p"], got["q"]
    assert (p.n_samples, p.n_rows, p.n_nd, p.lowest, p.highest) == (3, 3, 2, 1.0, 5.0)
    assert (p.lowest_nd, p.highest_nd, p.mean_nd) == (False, True, False)
    assert (q.n_rows, q.lowest, q.lowest_nd) == (2, 2.0, True)
    drop = {r.k: r for r in statistics.compliance(df, ["k"], mode="drop").collect()}
    assert (drop["q"].lowest, drop["q"].lowest_nd) == (None, None)


CROSSTAB = """Matrix: WATER
,,,,Sample Type:,REG,REG
,,,,ALS Sample number:,XX1234567001,XX1234567002
,,,,Sample Date:,07/05/2024,08/05/2024
,,,,Client sample ID (1st):,T.S01,T.S02
Analyte,CAS Number,Unit,LOR,,,
EA005: pH,,,,,,
pH Value,,pH Unit,0.01,,7.1,7.3
EG020: Metals,,,,,,
Arsenic,7440-38-2,mg/L,0.001,,<0.001,0.004
Matrix: SOIL
,,,,ALS Sample number:,XX1234567003,
Analyte,CAS Number,Unit,LOR,,,
Lead,7439-92-1,mg/kg,5,,12,
"""


def cells(spark, text):
    rows = [("f", "", r, c, v) for r, line in enumerate(text.splitlines(), 1) for c, v in enumerate(line.split(","), 1)]
    return spark.createDataFrame(rows, "file string, sheet string, r int, c int, v string")


def test_crosstab(spark):
    out = grids.unpivot_crosstab(cells(spark, CROSSTAB)).orderBy("section", "source_ref").collect()
    got = [(r.section, r.analyte_raw, r.method_raw, r.units_raw, r.lab_sample_id, r.feature_raw, r.value_raw) for r in out]
    assert got == [
        (1, "Arsenic", "EG020: Metals", "mg/L", "XX1234567001", "T.S01", "<0.001"),
        (1, "Arsenic", "EG020: Metals", "mg/L", "XX1234567002", "T.S02", "0.004"),
        (1, "pH Value", "EA005: pH", "pH Unit", "XX1234567001", "T.S01", "7.1"),
        (1, "pH Value", "EA005: pH", "pH Unit", "XX1234567002", "T.S02", "7.3"),
        (2, "Lead", None, "mg/kg", "XX1234567003", None, "12"),
    ]
    assert {r.sample_type for r in out} == {"Normal", "unknown"}


def test_unsupported_sections_are_left(spark):
    out = grids.unpivot_crosstab(cells(spark, CROSSTAB), dialect="^Matrix: SOIL")
    assert [r.analyte_raw for r in out.collect()] == ["Lead"]


def test_beside(spark):
    c = cells(spark, "x,REPORT NO,,R1,R2\ny,a,b,c,d")
    assert grids.beside(c, "^report no$").first()["values"] == ["R1", "R2"]
    assert grids.beside(c, "^report no$", "down").first()["values"] == ["a"]


def test_lines_of_a_water_sheet(spark):
    rows = [("Comments", None, 1, None, "comment"), ("Date", None, 1, None, "site_metadata_label"), ("Aroclor 1016", "%", 1, True, "aroclor_surrogate_percent"),
            ("Metals", None, 0, None, "heading"), ("Zinc", "mg/L", 2, True, "result"), ("Zinc (lab)", "mg/L", 2, None, "transcription_label")]
    df = spark.createDataFrame(rows, "a string, u string, n int, ok boolean, want string")
    got = df.select(grids.classify_line(F.col("a"), F.col("u"), F.col("n"), F.col("ok")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def registry_rows(spark):
    feature = spark.createDataFrame(
        [("f1", "T.S01", "T", None), ("f2", "T.S02", "T", None), ("f3", "T.S3", "T", "2020-06-30"), ("f4", "TH B7", "TH", None), ("f5", "T.S09", "T", None)],
        "uuid string, name string, site string, date_end string",
    ).withColumn("date_end", F.col("date_end").cast("date"))
    alias = spark.createDataFrame(
        [
            ("a1", "f1", "t.s01", "self", True, None, None), ("a2", "f2", "t.s02", "self", True, None, None), ("a3", "f3", "t.reused", "historical_code", True, None, None),
            ("a4", "f1", "t.reused", "historical_code", True, None, None), ("a5", "f1", "t.ambig", "historical_code", True, None, None), ("a6", "f2", "t.ambig", "historical_code", True, None, None),
            ("a7", "f2", "t.self", "self", True, None, None), ("a8", "f1", "t.self", "historical_code", True, None, None), ("a9", None, "t.s09", "pending", True, None, None),
            ("b1", "f4", "th b7", "self", True, None, None), ("b2", "f1", "t.old", "historical_code", True, None, "2019-01-01"), ("b3", "f1", "t.bore", "historical_code", False, None, None),
            ("b5", "f5", "point nine", "self", True, None, None),
        ],
        "uuid string, uuid_feature string, alias_key string, kind string, auto_assign boolean, date_start string, date_end string",
    )
    return feature, alias.withColumn("date_start", F.col("date_start").cast("date")).withColumn("date_end", F.col("date_end").cast("date"))


def test_feature_resolution(spark):
    feature, alias = registry_rows(spark)
    rows = [
        ("1", "e", "T.S01"), ("2", "e", " t.s02 "), ("3", "e", "T.REUSED"), ("4", "e", "t.ambig"), ("5", "e", "t.self"), ("6", "e", "T.S09"), ("7", "x", "TH.B007"),
        ("8", "e", "T.OLD"), ("9", "e", "t.bore"), ("10", "e", "S001"), ("11", "e", "--"), ("12", "e", None), ("13", "y", "S001"),
    ]
    df = spark.createDataFrame(rows, "row string, event string, raw string")
    df = df.select("*", F.lit(False).alias("orphan"), F.lit("2024-01-01").cast("date").alias("day"), F.lit(1.0).alias("confidence"))
    got = {r.row: (r.status, r.uuid_feature, r.resolution, r.confidence) for r in resolve.resolve_features(df, alias, feature).collect()}
    assert got == {
        "1": ("hit", "f1", "alias", 1.0), "2": ("hit", "f2", "alias", 1.0), "3": ("hit", "f1", "alias", 1.0), "4": ("pending", None, None, 1.0),
        "5": ("hit", "f2", "self_precedence", 1.0), "6": ("pending", None, None, 1.0), "7": ("hit", "f4", "structural", 0.9), "8": ("pending", None, None, 1.0),
        "9": ("pending", None, None, 1.0), "10": ("hit", "f1", "site_inferred", 0.8), "11": ("held", None, None, 1.0), "12": ("held", None, None, 1.0),
        "13": ("pending", None, None, 1.0),
    }


def test_best_source_and_orphans(spark):
    f = spark.createDataFrame([("W", "h1", "als_xtab/1", 5, 1, 3), ("W", "h2", "esdat/1", 0, 2, 3), ("W", "h3", "esdat/1", 9, 3, 0), ("W", "h4", "acirl_field_xlsx/1", None, 4, 0), (None, "h5", "other", None, 5, 1)],
                              "home string, hash string, adapter string, revision int, pos int, n_results int")
    f = f.withColumn("event", assemble.event_id(F.col("home"), F.col("hash")))
    got = {r.hash: (r.event, r.kept) for r in assemble.best_source(f).collect()}
    assert got == {"h1": ("wo::W", False), "h2": ("wo::W", True), "h3": ("wo::W", False), "h4": ("wo::W", True), "h5": ("__orphan__::h5", True)}


def test_reviews(spark):
    df = spark.createDataFrame([("k", "r2", ["f2"]), ("k", "r1", ["f1", "f2"]), ("m", "r3", None)], "key string, source_ref string, candidates array<string>")
    got = {r.key: (r.n_rows, r.source_ref, r.candidates) for r in reviews.review_rows(df, ["key"]).collect()}
    assert got == {"k": (2, "r1,r2", ["f1", "f2"]), "m": (1, "r3", [])}


def test_diff_and_checksum(spark):
    a = spark.createDataFrame([("1", 1), ("2", 2), ("3", None)], "uuid string, v int")
    b = spark.createDataFrame([("2", 5), ("3", None), ("4", 4)], "uuid string, v int")
    got = {r.k: r.kind for r in registry.full_diff(a, b, "uuid", ["v"]).collect()}
    assert got == {"1": "only_left", "2": "differs", "4": "only_right"}
    assert registry.checksum(a).collect() == registry.checksum(a.orderBy(F.desc("uuid"))).collect()
    assert registry.checksum(a).collect() != registry.checksum(b).collect()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "k string, sample string, value double, is_nd boolean")
    assert statistics.compliance(empty, ["k"]).count() == 0
    c = spark.createDataFrame([], "file string, sheet string, r int, c int, v string")
    assert grids.unpivot_crosstab(c).count() == 0


def test_alias_answers_by_spans(spark):
    """Days at every bound, an unknown day and unknown ends agree with rows taken one by one; a key's rows are answered once for each span, however many there are."""
    feature = spark.createDataFrame([("f1", "S", "2024-03-05"), ("f2", "S", None)], "uuid string, site string, date_end string").withColumn("date_end", F.col("date_end").cast("date"))
    known = [("x1", "f1", "historical_code", True, None, "2024-03-03"), ("x2", "f1", "self", True, "2024-03-04", None), ("x3", "f2", "self", False, "2024-03-02", "2024-03-02"), ("x4", None, "historical_code", True, None, "2024-03-06")]
    alias = spark.createDataFrame([(u, f, "k", *rest) for u, f, *rest in known], "uuid string, uuid_feature string, alias_key string, kind string, auto_assign boolean, date_start string, date_end string")
    alias = alias.withColumn("date_start", F.col("date_start").cast("date")).withColumn("date_end", F.col("date_end").cast("date"))
    days = [None, *[f"2024-03-0{d}" for d in range(1, 9)]]
    asked = [(f"{d}/{n}", "k", d) for d in days for n in range(50)] + [("other", "none", "2024-03-01"), ("null", None, None)]
    rows = spark.createDataFrame(asked, "row string, key string, day string").withColumn("day", F.col("day").cast("date"))

    live = lambda d, x: d is None or ((x[4] is None or x[4] <= d) and (x[5] is None or x[5] >= d))
    open_ = lambda d, x: live(d, x) and x[1] is not None and (d is None or x[1] != "f1" or d <= "2024-03-05")
    each = lambda f: {(row, a) for row, key, d in asked if key == "k" for a in f(d)}
    pairs = lambda df, c: {(r[0], r[1]) for r in df.select("row", c).collect()}
    assert pairs(resolve.candidates(rows, alias, feature), "fa_uuid") == each(lambda d: [x[0] for x in known if open_(d, x) and x[3]])
    assert pairs(resolve.suggestions(rows, alias, feature).withColumn("f", F.explode("features")), "f") == each(lambda d: {x[1] for x in known if open_(d, x)})
    assert pairs(resolve.expired(rows, alias, feature).withColumn("a", F.explode("aliases")), "a") == each(lambda d: [x[0] for x in known if not live(d, x)])
    assert pairs(resolve.narrowed_matches(rows, alias, feature), "fa_uuid") == each(lambda d: [x[0] for x in known if live(d, x) or not any(live(d, y) for y in known)])
    one, spans = resolve.spans(rows, alias, feature)
    assert one.count() == 450
    assert spans.count() == 7  # unknown; up to 1, 2, 3, 4 and 5, 6, from 7 on: x2 begins as x1 has ended


def _shuffles(df):
    """Exchanges of a plan that nothing is broadcast in; equal ones count each."""
    s = df.sparkSession
    was = s.conf.get("spark.sql.autoBroadcastJoinThreshold")
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        s.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    return [x for x in plan.splitlines() if "Exchange " in x]


def _sorts(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in x]


def test_matches_and_duplicates_cost_one_shuffle(spark):
    rows = spark.range(9).selectExpr("cast(id as string) as row", "'p' as point", "date '2024-01-01' as date", "cast(null as timestamp_ntz) as datetime", "'m' as uuid_lab", "'a' as uuid_analyte", "'als_lab' as kind", "id as pos")
    stored = rows.selectExpr("row as uuid", "point", "date", "datetime", "uuid_lab", "uuid_analyte", "'acirl_transcription' as kind", "1d as value", "'' as value_chr", "true as quantified", "1 as revision")
    found = reconcile.with_existing(rows, stored)
    assert {r.e_uuid for r in found.collect()} == {"0"}
    assert len(_shuffles(reconcile.with_existing(rows, stored))) == 1
    assert len(_shuffles(reconcile.twin_supersession(rows, stored))) == 1
    twice = reconcile.batch_duplicates(rows, ["point", "uuid_lab"])
    assert len(_shuffles(twice)) == 1 and len(_sorts(twice)) == 1


def test_stored_rows_are_joined_by_numbers(spark):
    from tarnlab.plans.roles import Roles

    found = _shuffles(Roles(spark, "/root/testdata/sf0.001").stored)
    assert found and not [x for x in found if "uuid" in x.split("hashpartitioning")[-1]]
    assert len([x for x in found if "l_orderkey" in x]) <= 2


def test_spine_moves_analyses_twice(spark):
    from tarnlab.operators import measurement
    from tarnlab.plans.roles import Roles

    r = Roles(spark, "/root/testdata/sf0.001")
    found = _shuffles(measurement.spine(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method))
    assert "(a_uuid_sample" in found[0] and len([x for x in found if "(a_uuid_" in x]) == 2  # the last join is that with samples that have their features
    plan = measurement.measurement_variant(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method, r.mask, "EPA")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window ") < plan.index("Join ")  # no join above the ranks


def test_crosstab_cells_are_moved_by_sheet_only(spark):
    c = spark.createDataFrame([("f", "", r, k, v) for r, row in enumerate([["Matrix: WATER"], ["ALS Sample number:", "", "", "", "S1"], ["Analyte", "CAS Number", "Unit", "LOR"], ["EA1"], ["pH", "", "-", "1", "7"]], 1) for k, v in enumerate(row, 1)], "file string, sheet string, r long, c int, v string")
    out = grids.unpivot_crosstab(c)
    assert [(r.analyte_raw, r.method_raw, r.lab_sample_id, r.value_raw) for r in out.collect()] == [("pH", "EA1", "S1", "7")]
    assert not [x for x in _shuffles(out) if "hashpartitioning" in x and (", r#" in x.split("hashpartitioning")[1] or ("analyte_raw" in x))]
