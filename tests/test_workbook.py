"""Workbook sheets and the archive of source files."""

import struct

import pytest
from pyspark.sql import functions as F

from tarnlab.operators import workbook
from tarnlab.sources import biff, files
from tarnlab.warehouse import archive
from tarnlab.warehouse.store import Store


def cells(spark, *sheets):
    rows = [("f", name, r, c, v) for name, grid in sheets for r, line in enumerate(grid, 1) for c, v in enumerate(line, 1)]
    return spark.createDataFrame(rows, "file string, sheet string, r int, c int, v string")


WATER = [
    ["", "Field results"],
    ["Sample Date", "", "45802", "", "01/06/2025"],
    ["Site Name", "Units", "T.S01", "T.S02", "T.S03"],
    ["Metals", "", "", "", ""],
    ["pH", "pH Units", "7.1", "--", "<6"],
    ["Temperature", "deg", "20", "21", ""],
    ["Zinc", "mg/L", "1", "", ""],
    ["Aroclor 1016", "%", "90", "", ""],
    ["Comments", "", "Clear, low flow", "", ""],
]


def test_water_sheet(spark):
    allowed = spark.createDataFrame([("ph",), ("temperature",)], "key string")
    out = workbook.water_sheet(cells(spark, ("W", WATER), ("X", [["nothing", "here"]])), allowed).collect()
    results = sorted((r.source_ref, r.kind, r.analyte_raw, r.units_raw, r.feature_raw, r.sample_date_raw, r.value_raw) for r in out if r.value_raw)
    assert results == [
        ("r5c3", "result", "pH", "pH", "T.S01", "25/05/2025", "7.1"),
        ("r5c4", "not_analysed", "pH", "pH", "T.S02", "25/05/2025", "--"),
        ("r5c5", "result", "pH", "pH", "T.S03", "01/06/2025", "<6"),
        ("r6c3", "result", "Temperature", "°C", "T.S01", "25/05/2025", "20"),
        ("r6c4", "result", "Temperature", "°C", "T.S02", "25/05/2025", "21"),
    ]
    assert sorted((r.sheet, r.analyte_raw or "", r.kind) for r in out if not r.value_raw) == [
        ("W", "Aroclor 1016", "aroclor_surrogate_percent"), ("W", "Comments", "comment"), ("W", "Metals", "heading"), ("W", "Zinc", "transcription_label"), ("X", "", "no_site_row"),
    ]


DUST = [
    ["GAUGE NO", "INSOLUBLE SOLIDS", "", "ASH"],
    ["D1", "1.5", "", "0.5"],
    ["D2", "", "2.5", "0.7"],
    ["Exposure Days", "30"],
    ["D1", "3.5", "", "0.9"],
]
SEEN = [["GAUGE", "DATE", "REMARKS"], ["D1", "01/05/2025", "Insects", "Leaves"], ["D2", "02/05/2025"], ["D1", "03/06/2025", "Clear"]]


def test_dust(spark):
    c = cells(spark, ("Dust", DUST))
    got = sorted((r.gauge, r.block, r.analyte_raw, r.value_raw, r.source_ref) for r in workbook.dust_sheet(c).collect())
    assert got == [
        ("D1", 1, "ASH", "0.5", "r2c4"), ("D1", 1, "INSOLUBLE SOLIDS", "1.5", "r2c2"), ("D1", 2, "ASH", "0.9", "r5c4"), ("D1", 2, "INSOLUBLE SOLIDS", "3.5", "r5c2"),
        ("D2", 1, "ASH", "0.7", "r3c4"), ("D2", 1, "INSOLUBLE SOLIDS", "2.5", "r3c3"),
    ]
    seen = sorted((r.gauge, r.block, str(r.date), r.comments) for r in workbook.dust_observations(cells(spark, ("Obs", SEEN))).collect())
    assert seen == [("D1", 1, "2025-05-01", "Insects; Leaves"), ("D1", 2, "2025-06-03", "Clear"), ("D2", 1, "2025-05-02", "")]


def test_sheet_kinds(spark):
    c = cells(spark, ("W", WATER), ("D", DUST), ("F", [["REPORT NO", "R1"]]), ("M", [["method"]]))
    assert {r.sheet: r.kind for r in workbook.sheet_kind(c).collect()} == {"W": "water", "D": "dust", "F": "front", "M": "other"}


def test_archive_and_verified_removal(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text("one")
    (inbox / "copy.csv").write_text("one")
    (inbox / "b.csv").write_text("two")
    store = Store(spark, f"file://{tmp_path}/store")
    f = files.read_files(spark, str(inbox)).cache()
    archive.archive_files(store, f.where("filename <> 'b.csv'"))
    archive.archive_files(store, f.where("filename <> 'b.csv'"))
    assert store.read("archive").count() == store.read("asset").count() == 1
    assert sorted(r.path.rsplit("/", 1)[1] for r in archive.removable(store, f).collect()) == ["a.csv", "copy.csv"]
    assert archive.remove(store, f, "file:/elsewhere") == 0
    assert archive.remove(store, f, f.first().folder) == 2
    assert [p.name for p in inbox.iterdir() if p.suffix == ".csv"] == ["b.csv"]
    assert archive.spent_folders(f, F.col("filename") != "b.csv").count() == 0
    assert archive.spent_folders(f, F.lit(True)).count() == 1
    assert not archive.inside("/a/b", "/a/b") and archive.inside("/a/b/c", "/a/b") and archive.inside("file:/a/b/c", "/a/b")
    assert not archive.inside("/a/b/../x", "/a/b") and not archive.inside("/a/bc", "/a/b") and not archive.inside("s3://h/a/b/c", "/a/b")


def record(kind, body):
    return struct.pack("<HH", kind, len(body)) + body


def compound(book: bytes) -> bytes:
    """A compound file with one stream, in small sectors if it is short."""
    entry = lambda n, kind, first, size: (n.encode("utf-16-le") + b"\0\0").ljust(64, b"\0") + struct.pack("<HB", 2 * len(n) + 2, kind) + b"\0" * 49 + struct.pack("<IQ", first, size)
    free, end = 0xFFFFFFFF, 0xFFFFFFFE
    chain = lambda first, n: [*range(first + 1, first + n), end]
    small = len(book) < 4096
    sectors = -(-len(book) // 512)
    data = 3 if small else 2
    fat = [0xFFFFFFFD, end] + ([end] if small else []) + chain(data, sectors)
    directory = entry("Root Entry", 5, data if small else end, len(book) if small else 0) + entry("Workbook", 2, 0 if small else data, len(book))
    minis = -(-len(book) // 64)
    mini_fat = struct.pack("<128I", *chain(0, minis), *[free] * (128 - minis)) if small else b""
    header = (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6)).ljust(44, b"\0")
    header += struct.pack("<IIIIIIII", 1, 1, 0, 4096, 2 if small else end, 1 if small else 0, end, 0) + struct.pack("<109I", 0, *[free] * 108)
    return header + struct.pack("<128I", *fat, *[free] * (128 - len(fat))) + directory.ljust(512, b"\0") + mini_fat + book.ljust(512 * sectors, b"\0")


def binary_book(sheets: list[tuple[str, list[tuple]]], strings: bytes = b"") -> bytes:
    """A BIFF8 workbook of sheets with cells (row, column, text or number, from 0) or ready records."""
    bodies = []
    for _, cells in sheets:
        body = record(0x809, b"")
        for cell in cells:
            if isinstance(cell, bytes):
                body += cell
            elif isinstance(cell[2], float):
                body += record(0x203, struct.pack("<HHHd", *cell[:2], 0, cell[2]))
            else:
                body += record(0x204, struct.pack("<HHHHB", *cell[:2], 0, len(cell[2]), 0) + cell[2].encode("latin-1"))
        bodies.append(body + record(0xA, b""))
    bound = lambda name, at: record(0x85, struct.pack("<IBBBB", at, 0, 0, len(name), 1) + name.encode("utf-16-le"))
    head = record(0x809, b"") + strings
    at = len(head) + sum(len(bound(n, 0)) for n, _ in sheets) + 4
    for (name, _), body in zip(sheets, bodies, strict=True):
        head += bound(name, at)
        at += len(body)
    return compound(head + record(0xA, b"") + b"".join(bodies))


def binary_workbook(pad: int) -> bytes:
    """Each kind of cell and a string that goes over a record's end; pad makes it large or small."""
    strings = struct.pack("<II", 2, 2) + struct.pack("<HB", 4, 0) + b"Site" + struct.pack("<HB", 6, 1) + "Namé".encode("utf-16-le")
    sst = record(0xFC, strings) + record(0x3C, b"\x00" + b"-x")
    cells = [
        record(0xFD, struct.pack("<HHHI", 0, 0, 0, 1)), (1, 2, 0.1), record(0x27E, struct.pack("<HHHI", 2, 0, 0, 45802 << 2 | 2)),
        record(0xBD, struct.pack("<HHHIHIH", 3, 1, 0, 150 << 2 | 3, 0, 7 << 2 | 2, 2)), record(0x6, struct.pack("<HHH", 4, 0, 0) + b"\0" * 6 + b"\xff\xff"),
        record(0x207, struct.pack("<HB", 2, 0) + b"ok"), (5, 0, "z"), record(0x5C, b"\0" * pad),
    ]
    return binary_book([("Wasser", cells)], sst)


@pytest.mark.parametrize("pad", [0, 5000])
def test_binary_workbooks(pad):
    whole = binary_workbook(pad)
    got = biff.workbook_cells(whole)
    assert got == [("Wasser", r, c, v, 1) for r, c, v in ((1, 1, "Namé-x"), (2, 3, "0.1"), (3, 1, "45802"), (4, 2, "1.5"), (4, 3, "7"), (5, 1, "ok"), (6, 1, "z"))]
    for n in range(0, len(whole), 97):  # whatever is missing, it is read or reported
        try:
            biff.workbook_cells(whole[:n])
        except biff.Damaged:
            pass
