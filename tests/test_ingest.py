"""Folders of files through routing, parsing, assembly, reconciliation and commit; edits of the registry."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarnlab.operators import event
from tarnlab.sources import adapters, files, readers
from tarnlab.warehouse import ingest, registry
from tarnlab.warehouse.store import Store


def chemistry(wo: str, value: str, sample: str = "001", analyte: str = "Arsenic", unit: str = "mg/L") -> str:
    row = dict.fromkeys(readers.CHEMISTRY, "")
    row |= {"SampleCode": wo + sample, "OriginalChemName": analyte, "Result": value, "Result_Unit": unit, "Method_Name": "EG020"}
    return ",".join(readers.CHEMISTRY) + "\n" + ",".join(row[c] for c in readers.CHEMISTRY) + "\n"


def sample(wo: str, point: str, when: str = "07 May 2024 10:30", number: str = "001") -> str:
    row = dict.fromkeys(readers.SAMPLE, "")
    row |= {"SampleCode": wo + number, "Sampled_Date_Time": when, "Field_ID": point, "Sample_Type": "Normal", "Lab_Report_Number": wo}
    return ",".join(readers.SAMPLE) + "\n" + ",".join(row[c] for c in readers.SAMPLE) + "\n"


def deliver(folder, wo="XX1234567", value="0.5", revision=0, point="Site.P1", when="07 May 2024 10:30", note=""):
    folder.mkdir(exist_ok=True)
    (folder / f"PROJ.ESDAT_{wo}_{revision}.Chemistry2e.CSV").write_text(chemistry(wo, value) + note)
    (folder / f"PROJ.ESDAT_{wo}_{revision}.Sample2e.CSV").write_text(sample(wo, point, when) + note)
    return str(folder)


@pytest.fixture
def store(spark, tmp_path):
    out = Store(spark, f"file://{tmp_path}/store")
    ingest.ensure_schema(out)
    registry.add_feature(out, "Site.P1", "Site", 150.0, -33.0, "me", "seed")
    a = registry.add_analyte(out, "Arsenic", "me", "seed", units="mg/L")
    out.append("lab_method", registry._one(out, "lab_method", uuid="lm1", uuid_analyte=a, name="Arsenic", method="EG020", organisation="ALS", units="mg/L"), "me", "seed")
    return out


def values(store):
    return sorted((r.value, r.revision) for r in store.read("analysis").collect())


def test_a_folder_is_ingested_once(spark, store, tmp_path):
    folder = deliver(tmp_path / "in")
    (tmp_path / "in" / "notes.bak").write_text("x")
    (tmp_path / "in" / "unknown.csv").write_text("a,b\n1,2\n")
    (tmp_path / "in" / "PROJ.ESDAT_XX7777777_0.Chemistry2e.CSV").write_text(",".join(readers.CHEMISTRY) + '\n"never closed\n')
    version = store.version
    dry = ingest.ingest_dir(store, folder, dry_run=True)
    assert dry.rows == {("clean", "new"): 1} and dry.events == 1 and store.version == version
    assert dry.files == {"assembled": 2, "ignored": 1, "quarantined": 1, "claimed": 1} or dry.files["assembled"] == 2

    done = ingest.ingest_dir(store, folder, snapshot="s1", remove=True)
    assert done.rows == {("clean", "new"): 1} and not done.blocked and done.reviews_opened == 0
    assert values(store) == [(0.5, 0)]
    s = store.read("sample").first()
    assert s.date == dt.date(2024, 5, 7) and s.datetime == dt.datetime(2024, 5, 7, 0, 30)
    assert store.read("project").first().name == "XX1234567"
    states = {r.filename.rsplit(".", 2)[-2]: (r.state, r.reason) for r in store.read("ingest_file").collect()}
    assert states["Sample2e"] == ("archived", None) and states["notes"][0] == "ignored" and states["unknown"] == ("quarantined", "unclaimed")
    assert done.removed == 2 and sorted(p.name for p in (tmp_path / "in").iterdir()) == ["PROJ.ESDAT_XX7777777_0.Chemistry2e.CSV", "notes.bak", "unknown.csv"]

    again = ingest.ingest_dir(store, folder)
    assert again.rows == {} and values(store) == [(0.5, 0)]


def test_redeliveries(spark, store, tmp_path):
    ingest.ingest_dir(store, deliver(tmp_path / "a"))
    same = ingest.ingest_dir(store, deliver(tmp_path / "b", note="\n"))
    assert same.rows == {("skipped", "already_present"): 1} and store.read("seen_again").count() == 1
    changed = ingest.ingest_dir(store, deliver(tmp_path / "c", value="0.7", note="\n\n"))
    assert changed.rows == {("review", "value_conflict"): 1} and changed.reviews_opened == 1
    newer = ingest.ingest_dir(store, deliver(tmp_path / "d", value="0.9", revision=1, note="\n\n\n"))
    assert newer.rows == {("clean", "supersede"): 1} and values(store) == [(0.9, 1)]
    folder = deliver(tmp_path / "e", when="09 May 2024 10:30", revision=1, note="\n\n\n\n")
    assert ingest.ingest_dir(store, folder, dry_run=True).blocked == 1 and store.read("review_queue").where("kind = 'work_order_reingest'").count() == 0
    other_day = ingest.ingest_dir(store, folder)
    assert other_day.blocked == 1 and other_day.stopped.first().event == "wo::XX1234567" and values(store) == [(0.9, 1)]
    assert store.read("review_queue").where("kind = 'work_order_reingest' and status = 'open'").count() == 1
    assert store.read("sample").count() == 1


def test_unknown_names_commit_dangling(spark, store, tmp_path):
    folder = tmp_path / "in"
    deliver(folder, point="Nowhere 7")
    (folder / "PROJ.ESDAT_XX1234567_0.Chemistry2e.CSV").write_text(chemistry("XX1234567", "3", analyte="Unobtainium"))
    out = ingest.ingest_dir(store, str(folder))
    assert out.rows == {("clean", "new"): 1} and out.reviews_opened == 2
    alias = store.read("feature_alias").where("kind = 'pending'").first()
    assert alias.alias_key == "nowhere 7" and alias.uuid_feature is None and store.read("sample").first().uuid_feature_alias == alias.uuid
    method = store.read("lab_method").where("uuid_analyte is null").first()
    assert (method.name, method.organisation, method.units) == ("Unobtainium", "ALS", "mg/L") and store.read("analysis").first().uuid_lab == method.uuid
    assert {r.kind for r in registry.review_queue(store).collect()} == {"unknown_feature", "unknown_analyte"}


def test_units_of_an_unknown_method_are_sighted(spark, store, tmp_path):
    for n, (wo, unit) in enumerate([("XX1111111", "mg/L"), ("XX2222222", "ug/L")]):
        folder = tmp_path / f"in{n}"
        deliver(folder, wo=wo, when=f"0{n + 1} May 2024 10:30")
        (folder / f"PROJ.ESDAT_{wo}_0.Chemistry2e.CSV").write_text(chemistry(wo, "3", analyte="Unobtainium", unit=unit))
        ingest.ingest_dir(store, str(folder))
    method = store.read("lab_method").where("uuid_analyte is null").first()
    assert method.units == "mg/L" and store.read("analysis").count() == 2
    log = store.read("change_log").where("tbl = 'lab_method' and action = 'provenance'").collect()
    assert [(r.uuid_row, r.field, r.old, r.new, r.reason) for r in log] == [(method.uuid, "units", "mg/L", "ug/L", "units drift")]
    assert log[0].source_hash in {r.hash for r in store.read("ingest_file").where("work_order = 'XX2222222'").collect()}


def test_inbox(spark, store, tmp_path):
    root = tmp_path / "inbox"
    root.mkdir()
    deliver(root / "1")
    deliver(root / "2", wo="XX2222222", point="Site.P1", when="08 May 2024")
    (root / "1" / "old.bak").write_text("x")
    (root / "2" / "notes.txt").write_text("keep")
    out = ingest.ingest_inbox(store, str(root), snapshot="day", remove=True)
    assert [(o.error, o.folder_removed) for o in out.values()] == [(None, True), (None, False)]
    assert len(values(store)) == 2 and not (root / "1").exists() and [p.name for p in (root / "2").iterdir()] == ["notes.txt"]


def test_crosstab_files(spark, tmp_path):
    body = (
        "Matrix: WATER\nWorkgroup: EM1\n,,,,Sample Type:,REG,REG\n,,,,ALS Sample number:,EM1001,EM1002\n,,,,Sample Date:,07/05/2024,08/05/2024\n"
        ',,,,Client sample ID (1st):,P1,"P\n2"\nAnalyte,CAS Number,Unit,Limit of reporting,,,\nEG020: Metals,,,,,,\nArsenic,7440-38-2,mg/L,0.001,,0.5,<0.001\n'
    )
    (tmp_path / "EM1234567_XTAB.csv").write_text(body)
    f = adapters.described(files.read_files(spark, str(tmp_path)))
    reg = adapters.built_in()
    assert reg.ids() == ["acirl_field_xlsx", "als_enmrg", "als_xtab", "esdat"]
    routed = files.route(f, files.claims(f, reg))
    assert [(r.state, r.adapter) for r in routed.collect()] == [("claimed", "als_xtab/1.0")]
    got = adapters.parse_claimed(f, routed, reg)
    assert sorted((r.feature_raw, r.value_raw, r.method_raw, r.units_raw, r.sample_datetime_raw) for r in got.results.collect()) == [
        ("P\n2", "<0.001", "EG020: Metals", "mg/L", "08/05/2024"), ("P1", "0.5", "EG020: Metals", "mg/L", "07/05/2024"),
    ]


def raw_rows(spark, *rows):
    names = "row event sample_type needs_review feature_raw analyte_raw org method_raw units_raw value_raw sample_datetime_raw revision".split()
    types = "string string string boolean string string string string string string string int".split()
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))
    more = {"orphan": F.lit(False), "source_hash": F.lit("h"), "source_ref": F.col("row"), "review_kind": F.when(F.col("needs_review"), "other"), "review_subkind": F.lit(None).cast("string")}
    return df.withColumns(more)


def test_every_stage_and_no_row_lost(spark, store):
    known = event.Registry.load(store)
    base = ("e", None, False, "Site.P1", "Arsenic", "ALS", "EG020", "mg/L", "0.5", "07 May 2024 10:30", 0)

    def row(name, **change):
        columns = "event sample_type needs_review feature_raw analyte_raw org method_raw units_raw value_raw sample_datetime_raw revision".split()
        return (name, *[change.get(c, v) for c, v in zip(columns, base, strict=True)])

    rows = raw_rows(
        spark, row("a"), row("b", needs_review=True), row("c", sample_type="LCS"), row("d", feature_raw="--"), row("e", analyte_raw="?!"), row("f", value_raw="NS"), row("g", value_raw="<abc"),
        row("h", units_raw="furlong"), row("i", units_raw=None), row("j", sample_datetime_raw="soon"), row("k", units_raw="7.5"), row("l"), row("m", feature_raw="Elsewhere"), row("n", event="e2", units_raw="ug/L", sample_datetime_raw="01 Jan 2023"),
    )
    got = {r.row: r for r in event.reconcile_events(rows, known).collect()}
    assert {k: (r.disposition, r.reason, r.subkind) for k, r in got.items()} == {
        "a": ("clean", "new", None), "b": ("review", "other", None), "c": ("skipped", "qc_LCS", None), "d": ("review", "unknown_feature", "held"), "e": ("review", "unknown_analyte", "held"),
        "f": ("skipped", "no_sample", None), "g": ("review", "parse_error", "value"), "h": ("review", "unknown_unit", None), "i": ("review", "units_implausible", "units_missing"),
        "j": ("review", "parse_error", "datetime"), "k": ("review", "units_implausible", "units_numeric"), "l": ("review", "batch_duplicate", None), "m": ("clean", "new", None), "n": ("clean", "new", None),
    }
    assert got["m"].notes == ["unknown_feature"] and got["n"].value == pytest.approx(0.0005)
    assert event.reconcile_events(rows.limit(0), known).count() == 0


def test_methods_duplicates_and_unknown_names(spark, store):
    """One point and day: methods compete within an event by their registered limits, and only one method's rows repeat each other."""
    a = registry.add_analyte(store, "Lead", "me", "seed", units="mg/L")
    for uuid, method, limit in (("m1", "M1", 0.1), ("m2", "M2", 0.01)):
        store.append("lab_method", registry._one(store, "lab_method", uuid=uuid, uuid_analyte=a, name="Lead", method=method, organisation="ALS", units="mg/L", rl_low=limit), "me", "seed")
    base = ("e", None, False, "Site.P1", "Lead", "ALS", "M1", "mg/L", "0.5", "07 May 2024 10:30", 0)

    def row(name, **change):
        columns = "event sample_type needs_review feature_raw analyte_raw org method_raw units_raw value_raw sample_datetime_raw revision".split()
        return (name, *[change.get(c, v) for c, v in zip(columns, base, strict=True)])

    rows = raw_rows(
        spark, row("a1", value_raw="5"), row("a2", method_raw="M2", value_raw="1"), row("a3", method_raw="M2", value_raw="1"), row("b1", event="e2"), row("c1", event="e3", method_raw="M2"),
        row("d1", event="e4", analyte_raw="Unobtainium", method_raw="X"), row("d2", event="e4", analyte_raw="Unobtainium", method_raw="Y"),
        row("f1", event="e5", feature_raw="Nowhere", method_raw="M2"), row("f2", event="e5", feature_raw="Nowhere", method_raw="M2"),
    )
    got = {r.row: (r.disposition, r.reason, r.kept_uuid_lab) for r in event.reconcile_events(rows, event.Registry.load(store)).collect()}
    assert got == {
        "a1": ("skipped", "method_duplicate", "m2"), "a2": ("clean", "new", None), "a3": ("review", "batch_duplicate", None), "b1": ("clean", "new", None), "c1": ("clean", "new", None),
        "d1": ("clean", "new", None), "d2": ("clean", "new", None), "f1": ("clean", "new", None), "f2": ("clean", "new", None),
    }


def test_turns(spark):
    rows = [("e1", "a"), ("e2", "a"), ("e2", "b"), ("e3", "b"), ("e4", "c"), ("e5", None), ("e6", None), ("e1", "d"), ("e4", "d")]
    df = spark.createDataFrame(rows, "event string, key string")
    assert {r.event: r.wave for r in event.waves(df, ["key"]).collect()} == {"e1": 0, "e2": 1, "e3": 2, "e4": 1, "e5": 0, "e6": 0}
    assert event.waves(df.limit(0), ["key"]).count() == 0


def test_events_of_one_batch_see_each_other(spark, store, tmp_path):
    """Two work orders of one visit: the second's like value is present, its other value a conflict; an undated one reuses the sample."""
    folder = tmp_path / "in"
    deliver(folder, wo="XX1111111")
    deliver(folder, wo="XX2222222", note="\n")
    deliver(folder, wo="XX3333333", value="0.7", note="\n\n")
    deliver(folder, wo="XX4444444", when="07 May 2024", note="\n\n\n")
    out = ingest.ingest_dir(store, str(folder))
    assert out.rows == {("clean", "new"): 1, ("skipped", "already_present"): 2, ("review", "value_conflict"): 1} and out.failed == 0
    assert store.read("sample").count() == 1 and values(store) == [(0.5, 0)]


def test_a_bad_event_is_left_out(spark, store, tmp_path, monkeypatch):
    """Two samples of one visit fit an undated row alike: that event fails; one that raises fails too; the third commits."""
    alias = store.read("feature_alias").first().uuid
    for k, hour in enumerate((8, 9)):
        stamp = dt.datetime(2024, 5, 7, hour)
        store.append("sample", registry._one(store, "sample", uuid=f"s{k}", uuid_feature_alias=alias, date=dt.date(2024, 5, 7), datetime=stamp), "me", "seed")
    folder = tmp_path / "in"
    deliver(folder, wo="XX1111111", when="07 May 2024")
    deliver(folder, wo="XX2222222", when="08 May 2024 10:00", note="\n")
    deliver(folder, wo="XX3333333", when="09 May 2024 10:00", note="\n\n")
    honest = ingest.commit_outcomes

    def poisoned(store, rows, actor, reason):
        if not rows.where("event = 'wo::XX3333333'").isEmpty():
            raise ArithmeticError("poison")
        honest(store, rows, actor, reason)

    monkeypatch.setattr(ingest, "commit_outcomes", poisoned)
    out = ingest.ingest_dir(store, str(folder))
    assert out.failed == 2 and {(r.event, r.state, r.fault) for r in out.stopped.collect()} == {
        ("wo::XX1111111", "failed", "several samples fit alike"), ("wo::XX3333333", "failed", "ArithmeticError: poison"),
    }
    assert out.rows == {("clean", "new"): 1} and store.read("analysis").count() == 1
    states = {(r.work_order, r.state) for r in store.read("ingest_file").collect()}
    assert states == {("XX1111111", "failed"), ("XX2222222", "archived"), ("XX3333333", "failed")}
    monkeypatch.setattr(ingest, "commit_outcomes", honest)
    with pytest.raises(RuntimeError, match="every event"):
        only = tmp_path / "only"
        deliver(only, wo="XX5555555", when="07 May 2024", note="\n\n\n\n")
        ingest.ingest_dir(store, str(only))


def test_siblings_and_first_dates(spark, store, tmp_path):
    folder = tmp_path / "in"
    deliver(folder, point="Nowhere 7", when="07 May 2024 10:30")
    (folder / "XX1234567_COA.pdf").write_bytes(b"certificate")
    (folder / "XX9999999_QC.pdf").write_bytes(b"of another order")
    (folder / "2400-7454-05 May.pdf").write_bytes(b"report")
    (folder / "photo.jpg").write_bytes(b"x")
    out = ingest.ingest_dir(store, str(folder))
    kept = {r.filename: r.type for r in store.read("asset").where("filename like '%.pdf'").collect()}
    assert out.retained == 1 and kept == {"XX1234567_COA.pdf": "Certificate of analysis"}  # two orders are named, so the folder says nothing of the report
    alias = lambda: store.read("feature_alias").where("kind = 'pending'").first()
    assert (alias().date_start, alias().n_seen) == (dt.date(2024, 5, 7), 1)
    second = tmp_path / "b"
    deliver(second, wo="XX2222222", point="Nowhere 7", when="09 May 2024 10:30", note="\n")
    deliver(second, wo="XX3333333", point="Nowhere 7", when="02 May 2024 10:30", note="\n\n")
    (second / "XX2222222_COC[1].pdf").write_bytes(b"custody")
    again = ingest.ingest_dir(store, str(second))
    assert again.retained == 1 and (alias().date_start, alias().n_seen) == (dt.date(2024, 5, 7), 3)  # ingest never moves a stored bound, a confirmation does
    assert store.read("asset").where("filename like '%COC%'").first().type == "QA"
    assert store.read("ingest_file").where("reason = 'retained_sibling'").count() == 2


def test_edits(spark, store):
    with pytest.raises(ValueError):
        registry.add_feature(store, " site.p1 ", "Site", 1.0, 1.0, "me", "again")
    with pytest.raises(ValueError):
        registry.add_feature(store, "--", "Site", 1.0, 1.0, "me", "nameless")
    p = registry.add_project(store, "Survey", "me", "seed")
    assert store.read("project").where(F.col("uuid") == p).first().type == "Work order"
    q = registry.add_review(store, "unknown_feature", "me", candidates=("f1", "f2"), work_order="W")
    assert [(r.rank, r.uuid_feature) for r in store.read("review_queue_candidate").orderBy("rank").collect()] == [(1, "f1"), (2, "f2")]
    assert registry.resolve_review(store, q, "done", "me") and not registry.resolve_review(store, q, "done", "me")
    f = store.read("feature").first().uuid
    found = registry.dependents(store.read, "feature", spark.createDataFrame([(f,)], "uuid string")).collect()
    assert [(r.tbl, r.field) for r in found] == [("feature_alias", "uuid_feature")]


def test_stored_values_are_converted_once(spark, store):
    a = registry.add_analyte(store, "Lead", "me", "seed", units="mg/L")
    store.append("lab_method", registry._one(store, "lab_method", uuid="lm2", uuid_analyte=a, name="Lead", method="X", organisation="ALS", units="ug/L"), "me", "seed")
    store.append("analysis", registry._one(store, "analysis", uuid="x1", uuid_lab="lm2", value=500.0, rl_low=10.0), "me", "seed")
    assert registry.convert_analyses(store, "lm2", "me") == {"converted": 1}
    assert registry.convert_analyses(store, "lm2", "me") == {}
    assert [(r.value, r.rl_low) for r in store.read("analysis").collect()] == [(pytest.approx(0.5), pytest.approx(0.01))]


def test_report_file(spark, tmp_path):
    registry.write_report(spark.createDataFrame([("a", 1.0, True)], "point string, low double, low_nd boolean"), f"file://{tmp_path}/r", ("low",))
    text = next((tmp_path / "r").glob("part-*.csv")).read_text().split()
    assert text == ["point,low,low_nd", "a,1.0,true"]


def test_field_workbooks(spark, tmp_path):
    """A binary workbook with a front page and a water sheet, through claim and parse."""
    from test_workbook import binary_book

    front = [(0, 0, "REPORT NO:"), (0, 2, "R-77"), (1, 0, "SAMPLED BY:"), (1, 1, "A & B")]
    water = [(2, 0, "Date"), (2, 2, 45802.0), (3, 0, "Site Name"), (3, 1, "Units"), (3, 2, "P1"), (4, 0, "pH"), (4, 1, "pH Unit"), (4, 2, 7.5)]
    (tmp_path / "2400-7286-10.xls").write_bytes(binary_book([("Front Page", front), ("Ponds", water)]))
    (tmp_path / "broken.xlsx").write_bytes(b"no workbook")
    f = adapters.described(files.read_files(spark, str(tmp_path)))
    reg = adapters.built_in(spark.createDataFrame([("ph",)], "key string"))
    routed = files.route(f, files.claims(f, reg))
    assert {r.filename: (r.state, r.adapter) for r in routed.collect()} == {"2400-7286-10.xls": ("claimed", "acirl_field_xlsx/1.0"), "broken.xlsx": ("quarantined", None)}
    got = adapters.parse_claimed(f, routed, reg)
    assert [(r.feature_raw, r.analyte_raw, r.value_raw, r.sample_datetime_raw, r.source_ref) for r in got.results.collect()] == [("P1", "pH", "7.5", "25/05/2025", "Ponds!r5c3")]
    assert [r.report_no for r in got.reports.collect()] == ["R-77"]
