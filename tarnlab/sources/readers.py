"""Readers: delimited files, grids, XML headers and workbooks, from binary file rows."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, values
from . import biff
from .files import decoded

#: Records of one frame that a reader gives back.
RECORDS = 10_000
#: Characters of files after which it is given back, though it holds fewer records.
CHARACTERS = 8_000_000

# Header lines of the exchange format.
CHEMISTRY = (
    "SampleCode", "ChemCode", "OriginalChemName", "Prefix", "Result", "Result_Unit", "Total_or_Filtered", "Result_Type", "Method_Type",
    "Method_Name", "Extraction_Date", "Analysed_Date", "EQL", "EQL_Units", "Comments", "Lab_Qualifier", "UCL", "LCL",
)
SAMPLE = (
    "SampleCode", "Sampled_Date_Time", "Field_ID", "Blank1", "Depth", "Blank2", "Matrix_Type", "Sample_Type", "Parent_Sample", "Blank3",
    "SDG", "Lab_Name", "Lab_SampleID", "Lab_Comments", "Lab_Report_Number",
)


def _closes(content: str, line: int) -> bool:
    """Whether the record that begins at a line, the last one, ends before the file does: its quotes are closed."""
    tail = content.split("\n", line - 1)[-1]
    try:
        for _ in csv.reader(io.StringIO(tail, newline=""), strict=True):
            pass
    except csv.Error as e:
        return "end of data" not in str(e)
    return True


def _records(content: str | None) -> Iterator[tuple[int, list[str], bool]]:
    """Records of one file: the line where each begins, its fields, and whether it ends before the file does."""
    content = content or ""
    reader, at, last = csv.reader(io.StringIO(content, newline="")), 1, None
    for fields in reader:
        if any(x.strip() for x in fields):
            if last is not None:
                yield (*last, True)
            last = (at, fields)
        at = reader.line_num + 1
    if last is not None:
        yield (*last, _closes(content, last[0]))


def _read(files: DataFrame, rows: Callable[[str, str | None], Iterator[tuple]], schema: dict[str, pa.DataType], ddl: str) -> DataFrame:
    """The rows that a function makes of each file; those of small files share a batch, those of a large one have several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(1 << 31)
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.values(), strict=True)], names=list(schema))

        for b in batches:
            for h, content in zip(b.column("hash").to_pylist(), b.column("content"), strict=True):
                content = content.as_py()
                size += len(content or "")
                for row in rows(h, content):
                    held.append(row)
                    if len(held) == RECORDS:
                        yield batch()
                        held, size = [], 0
                if held and size > CHARACTERS:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()

    return files.select("hash", decoded(F.col("content")).alias("content")).mapInArrow(run, ddl)


def raw_records(files: DataFrame) -> DataFrame:
    def rows(h: str, content: str | None) -> Iterator[tuple]:
        return ((h, *x) for x in _records(content))

    return _read(files, rows, {"hash": pa.string(), "r": pa.int32(), "fields": pa.list_(pa.string()), "whole": pa.bool_()}, "hash string, r int, fields array<string>, whole boolean")


def records(files: DataFrame) -> DataFrame:
    """Records of delimited text files: hash, r (the line where the record begins, from 1), fields (in order, any number).

    A quoted field may hold separators, doubled quotes and line breaks; blank lines are no
    records. A quote that never closes takes the rest of its file: that is no record, and
    `parse_faults` names the file.
    """
    return raw_records(files).where("whole").drop("whole")


def headers(files: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The first record of each delimited file: hash, header_r, header (names, trimmed).

    found: the files' raw_records, if they are at hand, so that the files aren't read again.
    """
    found = raw_records(files) if found is None else found
    g = found.where("whole").groupBy("hash").agg(F.min(F.struct("r", "fields")).alias("_h"))
    return g.select("hash", F.col("_h.r").alias("header_r"), F.transform("_h.fields", lambda x: F.trim(x)).alias("header"))


def delimited(files: DataFrame, columns: tuple[str, ...], found: DataFrame | None = None) -> DataFrame:
    """Rows of delimited files by the names in their header, whatever the order; every field is text, empty ones null.

    Files whose header lacks one of the columns give no rows: `parse_faults` names them.
    """
    if found is None:  # one pass: a file's header is at hand where its records are read
        return _named(files, columns)
    head = headers(files, found).where(F.array_except(F.array(*[F.lit(c) for c in columns]), "header") == F.array().cast("array<string>"))
    data = found.where("whole").join(head, "hash").where("r > header_r")
    field = lambda c: F.nullif(F.get("fields", F.array_position("header", F.lit(c)).cast("int") - 1), F.lit("")).alias(c)
    return data.select("hash", F.concat(F.lit("r"), F.col("r").cast("string")).alias("source_ref"), *[field(c) for c in columns])


def _named(files: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    def rows(h: str, content: str | None) -> Iterator[tuple]:
        found = _records(content)
        _, header, whole = next(found, (0, [], False))
        names = [x.strip(" ") for x in header]
        if not whole or any(c not in names for c in columns):
            return
        at = [names.index(c) for c in columns]
        for r, fields, whole in found:
            if whole:
                yield (h, f"r{r}", *[fields[i] or None if i < len(fields) else None for i in at])

    schema = {"hash": pa.string(), "source_ref": pa.string(), **{c: pa.string() for c in columns}}
    return _read(files, rows, schema, ", ".join(f"`{c}` string" for c in schema))


def parse_faults(files: DataFrame, columns: tuple[str, ...], found: DataFrame | None = None) -> DataFrame:
    """Delimited files that can't be read as a table of these columns: hash, fault, missing.

    corrupt: a quote never closes, or there are lines but no record behind the header.
    no_header: nothing in it. missing_columns: the header lacks some. A header alone is sound.
    """
    found = raw_records(files) if found is None else found
    content = decoded(F.col("content"))
    filled = F.size(F.filter(F.split(content, "\\r?\\n", -1), lambda x: F.trim(x) != ""))
    n = found.groupBy("hash").agg(F.count("*").alias("n_records"), F.bool_and("whole").alias("whole"))
    out = files.select("hash", filled.alias("n_lines")).join(headers(files, found), "hash", "left").join(n, "hash", "left")
    missing = F.array_except(F.array(*[F.lit(c) for c in columns]), "header")
    broken = ~F.col("whole") | ((F.col("n_lines") > 1) & (F.col("n_records") <= 1))
    fault = F.when(broken, "corrupt").when(F.col("header").isNull(), "no_header").when(F.size(missing) > 0, "missing_columns")
    return out.withColumn("fault", fault).where("fault is not null").select("hash", "fault", F.when(F.col("fault") == "missing_columns", missing).alias("missing"))


def grid(files: DataFrame) -> DataFrame:
    """Long cells of headerless delimited files of any width: file, sheet, r, c, v (empty cells are left out)."""
    cells = records(files).select("hash", "r", F.posexplode("fields").alias("_c", "v")).where("trim(coalesce(v, '')) <> ''")
    return cells.select(F.col("hash").alias("file"), F.lit("").alias("sheet"), "r", (F.col("_c") + 1).alias("c"), "v")


# Root, namespace and attributes of header files.
HEADER_ROOT, HEADER_SPACE = "ESdat", "escis.com.au"
HEADER_FIELDS = {"lab_report_number": "Lab_Report_Number", "date_reported": "Date_Reported", "project_id": "Project_ID", "lab_name": "Lab_Name"}


def header_xml(files: DataFrame) -> DataFrame:
    """Attributes of the first LabReport of exchange header files; is_valid tells whether root and namespace fit.

    What isn't XML is not valid and has no attributes.
    """
    columns = ["hash", "is_valid", *HEADER_FIELDS]

    def read(h: str, content: bytes) -> tuple:
        try:
            root = ElementTree.fromstring(bytes(content))
        except ElementTree.ParseError:
            return (h, False, *[None] * len(HEADER_FIELDS))
        space, _, name = root.tag.rpartition("}")
        report = next((x for x in root.iter() if x.tag.rpartition("}")[2] == "LabReport"), None)
        found = [(report.get(k) or None) if report is not None else None for k in HEADER_FIELDS.values()]
        return (h, name == HEADER_ROOT and HEADER_SPACE in space, *found)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([read(h, c) for h, c in zip(f["hash"], f["content"], strict=True)], columns=columns)

    return files.select("hash", "content").mapInPandas(run, "hash string, is_valid boolean, " + ", ".join(f"{c} string" for c in HEADER_FIELDS))


def chemistry_results(rows: DataFrame, org: str = "ALS") -> DataFrame:
    """Results of chemistry rows, one projection: work order, quality-control type, CAS, value and date."""
    raw = F.concat(F.coalesce("Prefix", F.lit("")), F.coalesce("Result", F.lit("")))
    ncp = values.is_true(F.col("SampleCode").rlike(text.NCP_CODE))
    return rows.select(
        F.col("hash").alias("source_hash"), "source_ref",
        F.nullif(F.regexp_extract("SampleCode", f"^({text.WORK_ORDER})", 1), F.lit("")).alias("work_order"),
        F.lit(org).alias("org"), F.col("SampleCode").alias("lab_sample_id"), F.when(ncp, "NCP").alias("sample_type"),
        text.normalise_lab_text(F.col("OriginalChemName")).alias("analyte_raw"),
        F.when(F.col("ChemCode").rlike(text.CAS_NUMBER), F.col("ChemCode")).alias("cas_number"),
        F.col("Method_Name").alias("method_raw"), F.col("Total_or_Filtered").alias("total_or_filtered"),
        text.normalise_lab_text(F.col("Result_Unit")).alias("units_raw"), raw.alias("value_raw"), values.parse_value(raw).alias("parsed"),
        F.col("EQL").try_cast("double").alias("rl"), F.col("Lab_Qualifier").alias("lab_qualifier"),
        F.to_date(dates.parse_local(F.col("Analysed_Date"), "esdat")).alias("analysed_date"), F.col("Comments").alias("comments"),
    )


def sample_rows(rows: DataFrame, org: str = "ALS") -> DataFrame:
    code = F.nullif(F.regexp_extract("SampleCode", f"^({text.WORK_ORDER})", 1), F.lit(""))
    return rows.select(
        F.col("hash").alias("source_hash"), "source_ref", F.coalesce("Lab_Report_Number", code).alias("work_order"), F.lit(org).alias("org"),
        F.col("SampleCode").alias("lab_sample_id"), F.col("Field_ID").alias("feature_raw"), F.col("Sampled_Date_Time").alias("sample_datetime_raw"),
        dates.parse_lab_datetime(F.col("Sampled_Date_Time"), "esdat").alias("sample_datetime"), F.col("Sample_Type").alias("sample_type"),
        F.col("Parent_Sample").alias("parent_sample"), F.col("Matrix_Type").alias("matrix_raw"), F.col("Lab_Comments").alias("comments"),
    )


def _column(reference: str) -> int:
    n = 0
    for ch in reference:
        n = 26 * n + ord(ch) - 64
    return n


def workbook_cells(content: bytes) -> list[tuple[str, int, int, str, int]]:
    """Cells of an XLSX workbook as text: sheet, r, c, v, sheet_no (from 1). A workbook is a zip of XML parts."""
    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    link = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{main}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{main}t")))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for number, sheet in enumerate(ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{main}sheet"), 1):
            target = targets[sheet.get(link)].lstrip("/")
            part = target if target.startswith("xl/") else f"xl/{target}"
            for cell in ElementTree.fromstring(z.read(part)).iter(f"{main}c"):
                m = re.fullmatch(r"([A-Z]+)(\d+)", cell.get("r", ""))
                kind, v = cell.get("t"), cell.find(f"{main}v")
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in cell.iter(f"{main}t"))
                elif v is None or v.text is None:
                    continue
                else:
                    value = shared[int(v.text)] if kind == "s" else v.text
                if m and value.strip():
                    out.append((sheet.get("name"), int(m[2]), _column(m[1]), value, number))
    return out


def workbook(files: DataFrame) -> DataFrame:
    """Long cells of XLSX and XLS files: file, sheet, r, c, v, sheet_no. Files that aren't workbooks give one row with sheet null."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for h, content in zip(f["hash"], f["content"], strict=True):
                try:
                    content = bytes(content)
                    cells = biff.workbook_cells if content.startswith(biff.MAGIC) else workbook_cells
                    rows += [(h, *cell) for cell in cells(content)]
                except (biff.Damaged, zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
                    rows.append((h, None, 0, 0, f"unreadable: {type(e).__name__}", 0))
            yield pd.DataFrame(rows, columns=["file", "sheet", "r", "c", "v", "sheet_no"])

    return files.select("hash", "content").mapInPandas(run, "file string, sheet string, r int, c int, v string, sheet_no int")
