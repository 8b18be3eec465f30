"""The store, sources and streaming."""

import io
import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tarnlab.sources import files, readers
from tarnlab.streaming import ingest
from tarnlab.warehouse.store import Conflict, Store, commit_outcomes


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def rows(spark, *data):
    return spark.createDataFrame(list(data), "uuid string, name string, n int")


def test_append_update_delete(spark, store):
    store.append("t", rows(spark, ("1", "a", 1), ("2", "b", 2)), "me", "first")
    store.update("t", spark.createDataFrame([("1", "a", 5)], "uuid string, name string, n int"), "me", "fix")
    store.delete("t", spark.createDataFrame([("2",)], "uuid string"), "me", "gone")
    assert [tuple(r) for r in store.read("t").collect()] == [("1", "a", 5)]
    log = [(r.action, r.uuid_row, r.field, r.old, r.new) for r in store.read("change_log").orderBy("action", "uuid_row").collect()]
    assert [x[:2] for x in log] == [("delete", "2"), ("insert", "1"), ("insert", "2"), ("update", "1")]
    assert log[3][2:] == ("n", "1", "5")
    assert store.version == 3


def test_a_failed_transaction_leaves_nothing(spark, store):
    store.append("t", rows(spark, ("1", "a", 1)), "me", "first")
    with pytest.raises(ZeroDivisionError), store.transaction():
        store.append("t", rows(spark, ("2", "b", 2)), "me", "second")
        assert store.read("t").count() == 2
        1 / 0
    assert store.read("t").count() == 1
    assert store.version == 1


def test_updates_name_exactly_one_row(spark, store):
    store.append("t", rows(spark, ("1", "a", 1)), "me", "first")
    with pytest.raises(ValueError):
        store.update("t", spark.createDataFrame([("9", 1)], "uuid string, n int"), "me", "x")


def test_reviews_and_snapshot(spark, store):
    q = spark.createDataFrame([("r1", "open", "k", "t1"), ("r2", "open", "m", "t1")], "uuid string, status string, kind string, uuid_target string")
    q = q.withColumn("resolution", F.lit(None).cast("string")).withColumn("resolved_by", F.lit(None).cast("string"))
    store.append("review_queue", q, "me", "open")
    assert store.close_review("t1", "k", "done", "me") == 1
    assert store.close_review("t1", "k", "done", "me") == 0
    assert {r.uuid: r.status for r in store.read("review_queue").collect()} == {"r1": "closed", "r2": "open"}
    assert store.snapshot("2024-01-01")["review_queue"] == 2


def test_commit(spark, store):
    old = spark.createDataFrame([("x1", "s", "lm", 1.0, None, None, True, 1)], "uuid string, uuid_sample string, uuid_lab string, value double, rl_low double, value_chr string, quantified boolean, revision int")
    store.append("analysis", old, "me", "seed")
    new = spark.createDataFrame(
        [("r1", "new", None, "s", "lm", 3.0, 0.5, None, True, 1, 2.0), ("r2", "supersede", "x1", "s", "lm", 7.0, None, None, True, 2, None)],
        "row string, outcome string, e_uuid string, uuid_sample string, uuid_lab string, value double, rl_low double, value_chr string, quantified boolean, revision int, conversion_constant double",
    )
    commit_outcomes(store, new, "me", "batch")
    assert sorted((r.value, r.rl_low, r.revision) for r in store.read("analysis").select("value", F.coalesce("rl_low", F.lit(-1.0)).alias("rl_low"), "revision").collect()) == [(6.0, 1.0, 1), (7.0, -1.0, 2)]
    assert store.version == 2


CHEM = ",".join(readers.CHEMISTRY) + '\n"XX1234567001",7440-38-2,Arsenic,<,0.001,mg/L,T,REG,,EG020,,"07 May 2024",0.001,mg/L,,,,\nXX1234567_XX7654321,PH,"pH, field",,7.1,pH Unit,T,REG,,EA005,,,,,,,,\n'


def test_delimited_files(spark, tmp_path):
    (tmp_path / "PROJ.ESDAT_XX1234567_0.Chemistry2e.CSV").write_bytes(b"\xef\xbb\xbf" + CHEM.encode())
    f = files.read_files(spark, str(tmp_path))
    meta = f.first()
    assert (meta.ext, meta.work_order_guess, meta.revision_guess) == ("csv", "XX1234567", 0)
    got = readers.chemistry_results(readers.delimited(f, readers.CHEMISTRY)).orderBy("source_ref").collect()
    assert [(r.work_order, r.sample_type, r.analyte_raw, r.cas_number, r.parsed.value_num, r.parsed.quantified, str(r.analysed_date)) for r in got] == [
        ("XX1234567", None, "Arsenic", "7440-38-2", 0.001, False, "2024-05-07"),
        ("XX1234567", "NCP", "pH, field", None, 7.1, True, "None"),
    ]
    cells = readers.grid(f).where("r = 2 and c = 3").first()
    assert cells.v == "Arsenic"


def test_encoding_fallback(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("25 µg".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("25 µg".encode())
    f = files.read_files(spark, str(tmp_path))
    assert {r.x for r in f.select(files.decoded(F.col("content")).alias("x")).collect()} == {"25 µg"}


def test_header_xml(spark, tmp_path):
    good = '<?xml version="1.0"?><ESdat xmlns="http://www.escis.com.au/2013/XML"><LabReport Lab_Report_Number="ES1" Date_Reported="2024-05-07" Project_ID="P" Lab_Name="L"/></ESdat>'
    (tmp_path / "h.xml").write_text(good)
    r = readers.header_xml(files.read_files(spark, str(tmp_path))).first()
    assert (r.is_valid, r.lab_report_number, r.lab_name) == (True, "ES1", "L")


def workbook() -> bytes:
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="Water" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Site Name</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row r="3"><c r="B3" t="s"><v>0</v></c><c r="AA3"><v>45802</v></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    (tmp_path / "w.xlsx").write_bytes(workbook())
    (tmp_path / "z.xlsx").write_bytes(b"no zip")
    got = sorted((r.sheet or "", r.r, r.c, r.v) for r in readers.workbook(files.read_files(spark, str(tmp_path))).collect())
    assert got == [("", 0, 0, "unreadable: BadZipFile"), ("Water", 3, 2, "Site Name"), ("Water", 3, 27, "45802")]


def test_stream_takes_each_content_once(spark, tmp_path):
    """However old a file's time is: what counts is whether its content is stored."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text("same")
    (inbox / "b.csv").write_text("same")
    (inbox / "c.csv").write_text("other")
    seen = []
    commit = lambda df, k: seen.extend(r.hash for r in df.select("hash").collect())
    known = lambda: spark.createDataFrame([(h,) for h in seen], "hash string")
    run = lambda: ingest.ingest(ingest.file_stream(spark, str(inbox)), f"{tmp_path}/checkpoint", commit, known)
    run()
    (inbox / "late.csv").write_text("thirty days old")
    os.utime(inbox / "late.csv", (time.time() - 30 * 86400,) * 2)
    (inbox / "again.csv").write_text("same")
    run()
    assert len(seen) == len(set(seen)) == 3


def test_an_append_writes_its_rows_alone(spark, store):
    for k in range(3):
        store.append("t", rows(spark, (str(k), "a", k)), "me", "more")
    parts = store.tables()["t"]
    assert len(parts) == 3 and all(spark.read.parquet(f"{store.root}/{p}").count() == 1 for p in parts)
    store.append("t", spark.createDataFrame([("9", "x")], "uuid string, extra string"), "me", "wider")
    assert store.read("t").where("uuid = '9' and n is null and extra = 'x'").count() == 1
    store.update("t", spark.createDataFrame([("1", 7)], "uuid string, n int"), "me", "fix")
    assert set(parts[:1] + parts[2:]) < set(store.tables()["t"]) and parts[1] not in store.tables()["t"]  # only the part that holds the row is written anew
    store.delete("t", spark.createDataFrame([("2",)], "uuid string"), "me", "gone")
    assert sorted((r.uuid, r.n) for r in store.read("t").where("n is not null").collect()) == [("0", 0), ("1", 7)]
    store.append("t", rows(spark, ("2", "a", 2)), "me", "back")
    store.append("t", rows(spark).limit(0), "me", "nothing")
    store.compact("t")
    assert len(store.tables()["t"]) == 1 and store.read("t").count() == 4


def test_one_of_two_writers_of_a_version_conflicts(spark, store):
    store.append("t", rows(spark, ("1", "a", 1)), "me", "first")
    other = Store(spark, store.root)
    with pytest.raises(Conflict), store.transaction():
        store.append("t", rows(spark, ("2", "b", 2)), "me", "mine")
        other.append("t", rows(spark, ("3", "c", 3)), "you", "yours")
    assert sorted(r.uuid for r in store.read("t").collect()) == ["1", "3"]
    assert store.version == 2


def text_files(spark, *contents):
    return spark.createDataFrame([(str(i), bytearray(c.encode())) for i, c in enumerate(contents)], "hash string, content binary")


def test_records_with_breaks_and_any_width(spark):
    f = text_files(spark, 'a,b\n1,"two\nlines"\n\n3,"say ""x"""\n', ",".join(str(i) for i in range(300)))
    assert [(r.r, r.fields) for r in readers.records(f.where("hash = '0'")).orderBy("r").collect()] == [(1, ["a", "b"]), (2, ["1", "two\nlines"]), (5, ["3", 'say "x"'])]
    assert readers.grid(f.where("hash = '1'")).count() == 300


def test_columns_are_matched_by_name(spark):
    f = text_files(spark, "B,A,C\nb1,a1,c1\n", "A\n1\n", "", "A,B\n", 'A,B\n"never closed\n1,2\n3,4\n')
    got = readers.delimited(f, ("A", "B")).collect()
    assert [(r.hash, r.source_ref, r.A, r.B) for r in got if r.hash == "0"] == [("0", "r2", "a1", "b1")]
    faults = {r.hash: (r.fault, r.missing) for r in readers.parse_faults(f, ("A", "B")).collect()}
    assert faults == {"1": ("missing_columns", ["B"]), "2": ("no_header", None), "4": ("corrupt", None)}
    corrupt = text_files(spark, '"A,B\n1,2\n')
    assert [r.fault for r in readers.parse_faults(corrupt, ("A", "B")).collect()] == ["corrupt"]


def test_header_xml_of_any_spelling(spark):
    xml = "<?xml version='1.0'?><!-- <LabReport Lab_Report_Number='no'/> --><e:ESdat xmlns:e='http://www.escis.com.au/2013/XML'><e:LabReport Lab_Report_Number='A &amp; B'  Lab_Name=''/></e:ESdat>"
    got = {r.hash: r for r in readers.header_xml(text_files(spark, xml, "<ESdat/>", "no xml")).collect()}
    assert (got["0"].is_valid, got["0"].lab_report_number, got["0"].lab_name) == (True, "A & B", None)
    assert not got["1"].is_valid and not got["2"].is_valid


def test_types_are_checked_before_anything_is_published(spark, store):
    store.append("t", spark.createDataFrame([("1", 1)], "uuid string, n bigint"), "me", "first")
    store.append("t", spark.createDataFrame([("2", 2)], "uuid string, n int"), "me", "narrower")
    version = store.version
    for n in ("string", "double", "date"):
        with pytest.raises(TypeError):
            store.append("t", spark.createDataFrame([("3", None)], f"uuid string, n {n}"), "me", "other")
    with pytest.raises(TypeError):
        store.update("t", spark.createDataFrame([("1", "x")], "uuid string, n string"), "me", "other")
    store.append("t", spark.sql("SELECT '4' AS uuid, NULL AS n"), "me", "nothing known")
    assert store.version == version + 1 and store.read("t").schema["n"].dataType.simpleString() == "bigint"
    assert sorted((r.uuid, r.n) for r in store.read("t").collect()) == [("1", 1), ("2", 2), ("4", None)]


def test_an_update_rewrites_the_files_that_hold_its_rows(spark, store):
    many = spark.range(40).select(F.col("id").cast("string").alias("uuid"), F.col("id").cast("int").alias("n")).repartitionByRange(8, F.col("n"))
    store.append("t", many, "me", "first load")
    (folder,) = store.tables()["t"]
    files = store._files(folder)
    assert len(files) == 8
    store.update("t", spark.createDataFrame([("3", 300)], "uuid string, n int"), "me", "fix")
    kept = set(store.tables()["t"]) & set(files)
    assert len(kept) == 7
    store.delete("t", spark.createDataFrame([("39",), ("3",)], "uuid string"), "me", "gone")
    assert len(set(store.tables()["t"]) & set(files)) == 6
    assert sorted(r.n for r in store.read("t").collect()) == [n for n in range(39) if n != 3]


def test_snapshots_are_kept_pointers(spark, store):
    store.append("t", rows(spark, ("1", "a", 1)), "me", "first")
    assert store.snapshot("day")["t"] == 1
    store.append("t", rows(spark, ("2", "b", 2)), "me", "second")
    store.delete("t", spark.createDataFrame([("1",)], "uuid string"), "me", "mistake")
    store.restore("day")
    assert [r.uuid for r in store.read("t").collect()] == ["1"]
    store.append("t", rows(spark, ("3", "c", 3)), "me", "third")
    assert store.snapshot("day")["t"] == 2 and store.snapshot("other")["t"] == 2
    assert store.prune_snapshots(["other"]) == ["day"] and store.snapshots() == ["other"]
    store.restore("other")
    assert store.read("t").count() == 2


def test_small_files_are_read_once_and_share_batches(spark):
    f = spark.range(3000, numPartitions=1).selectExpr("cast(id as string) as hash", "cast(concat('\"A\", B \r\n1,', id, '\r\n2') as binary) as content")
    rows = readers.delimited(f, ("B", "A"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
    got = {(r.hash, r.source_ref, r.B, r.A) for r in rows.collect()}
    assert got == {(str(i), "r2", str(i), "1") for i in range(3000)} | {(str(i), "r3", None, "2") for i in range(3000)}
    batches = readers.raw_records(f).mapInArrow(lambda it: (b.slice(0, 1) for b in it), "hash string, r int, fields array<string>, whole boolean").count()
    assert batches == 1 + 8999 // readers.RECORDS
