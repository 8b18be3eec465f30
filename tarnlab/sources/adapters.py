"""The built-in adapters: exchange files, two crosstab dialects and field workbooks.

An adapter claims files by what `described` says of them, and parses the files that it got
into three tables: results, samples and reports, whose columns are the same for all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, values
from ..operators import grids, workbook
from ..warehouse.scratch import written
from . import readers
from .files import Adapter, Registry

# Marks by which files are claimed, and how far they are looked for.
CROSSTAB_PEEK_BYTES, CROSSTAB_PEEK_LINES, WORKBOOK_PEEK_ROWS = 65_536, 20, 10
UNITS_ROWS, DUST_ROWS = 15, 20
DIALECTS = {"als_xtab": "^Matrix:", "als_enmrg": "^Client - Matrix:"}
WORKGROUP = "Workgroup:"
BUILT_IN_VERSION = "1.0"
FIELD_SHAPED = r"(^|[^0-9])2400-?[0-9]{4}"

# Types of deliverables that no adapter reads, by the ends of their names, and the token that marks them.
DELIVERABLE = r"(?i)_(coa|coc|qc|qci|xtab)\b"
ASSET_TYPES = (("coa", "Certificate of analysis"), ("qci", "QC"), ("qc", "QC"), ("coc", "QA"), ("xtab", "Chemical analysis"))

RESULTS = (
    "source_hash string, source_ref string, adapter string, work_order string, org string, lab_sample_id string, sample_type string, feature_raw string, "
    "analyte_raw string, cas_number string, method_raw string, units_raw string, value_raw string, limit_raw string, sample_datetime_raw string, comments string"
)
SAMPLES = "source_hash string, source_ref string, lab_sample_id string, feature_raw string, sample_datetime_raw string, sample_type string, parent_sample string, matrix_raw string"
REPORTS = "source_hash string, work_order string, report_no string, date_reported string, project_id string"


def is_field_shaped(filename: Column) -> Column:
    """Whether a file's name bears the number of a field job."""
    return F.coalesce(filename.rlike(FIELD_SHAPED), F.lit(False))


def is_deliverable(filename: Column) -> Column:
    """Whether a file's name is that of a laboratory's document: with such a token, or a field job's number."""
    return F.coalesce(filename.rlike(DELIVERABLE), F.lit(False)) | is_field_shaped(filename)


def asset_type(filename: Column) -> Column:
    """The type under which a document is kept."""
    kind = F.lit("Chemical analysis")
    for token, name in reversed(ASSET_TYPES):
        kind = F.when(filename.rlike(rf"(?i)_{token}(\[[0-9]+\])?\.[a-z0-9]+$"), name).otherwise(kind)
    return kind


def has_units_marker(cells: DataFrame) -> DataFrame:
    """Sheets (file, sheet) with a cell that reads Units near the top."""
    return cells.where((F.col("r") <= UNITS_ROWS) & (F.trim("v") == "Units")).select("file", "sheet").distinct()


def has_dust_marker(cells: DataFrame) -> DataFrame:
    """Sheets (file, sheet) with both headers of a dust sheet near the top."""
    top = cells.where(F.col("r") <= DUST_ROWS).withColumn("v", F.trim("v"))
    mark = lambda p: F.bool_or(F.col("v").rlike(f"(?i){p}"))
    g = top.groupBy("file", "sheet").agg(mark("^GAUGE NO").alias("_a"), mark("^INSOLUBLE SOLID").alias("_b"))
    return g.where("_a and _b").select("file", "sheet")


def peek_lines(content: Column) -> Column:
    """The first lines of a text file as Latin-1, without byte order mark and null bytes: enough for marks in ASCII."""
    lead = F.translate(F.decode(F.substring(content, 1, CROSSTAB_PEEK_BYTES), "ISO-8859-1"), "\0", "")
    return F.slice(F.split(F.regexp_replace(lead, "^ï»¿", ""), "\r\n|\n", -1), 1, CROSSTAB_PEEK_LINES)


def described(files: DataFrame) -> DataFrame:
    """files with what adapters look at: header, first_line, has_workgroup, is_field_book.

    Workbooks are opened once; text files are judged by their first lines alone.
    """
    is_csv, is_book = F.col("ext") == "csv", F.col("ext").isin("xls", "xlsx")
    cells = readers.workbook(files.where(is_book)).where("sheet is not null")
    top = cells.where((F.col("sheet_no") == 1) & (F.col("r") <= WORKBOOK_PEEK_ROWS)).groupBy("file").agg(
        F.min(F.when(F.col("r") == 1, F.struct("c", "v")))["v"].alias("book_first"), F.bool_or(F.col("v").contains(WORKGROUP)).alias("book_workgroup")
    )
    front = cells.where(F.lower("sheet").contains("front")).select("file").distinct()
    dust = has_dust_marker(cells.where(F.lower("sheet").contains("dust results")))
    field = has_units_marker(cells).select("file").union(dust.select("file")).distinct().join(front, "file", "left_semi").withColumn("field_book", F.lit(True))
    lines = F.when(is_csv, peek_lines(F.col("content")))
    header = F.transform(F.split(F.regexp_replace(text.strip_bom(F.get(lines, 0)), '"', ""), ","), lambda x: F.trim(x))
    out = files.join(top.withColumnRenamed("file", "hash"), "hash", "left").join(field.withColumnRenamed("file", "hash"), "hash", "left")
    return out.select(
        *files.columns, F.when(is_csv, header).alias("header"), F.coalesce(F.get(lines, 0), "book_first").alias("first_line"),
        F.coalesce(F.exists(lines, lambda x: x.contains(WORKGROUP)), "book_workgroup", F.lit(False)).alias("has_workgroup"),
        values.is_true(F.col("field_book")).alias("is_field_book"),
    )


def _names(columns: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(c) for c in columns])


def match_exchange(files: DataFrame) -> Column:
    """exact: a header file of the exchange's namespace, or a file whose header is one of the two known ones."""
    xml = (F.col("ext") == "xml") & F.col("peek").contains(readers.HEADER_SPACE)
    csv = (F.col("ext") == "csv") & ((F.col("header") == _names(readers.CHEMISTRY)) | (F.col("header") == _names(readers.SAMPLE)))
    return F.when(F.coalesce(xml, F.lit(False)) | F.coalesce(csv, F.lit(False)), "exact")


def match_crosstab(dialect: str) -> Callable[[DataFrame], Column]:
    """format: the first line begins as the dialect's does and one of the first names a workgroup."""
    return lambda files: F.when(F.col("ext").isin("csv", "xls", "xlsx") & F.coalesce(F.col("first_line").rlike(DIALECTS[dialect]), F.lit(False)) & F.col("has_workgroup"), "format")


def match_field(files: DataFrame) -> Column:
    """format: a workbook with a front sheet, and a sheet of water or dust results."""
    return F.when(F.col("ext").isin("xls", "xlsx") & F.col("is_field_book"), "format")


def _typed(df: DataFrame, schema: str) -> DataFrame:
    """df with exactly the columns of a schema; missing ones are null."""
    have = set(df.columns)
    parts = [p.split() for p in schema.split(", ")]
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in parts])


@dataclass(frozen=True)
class Parsed:
    """What files say: results, samples and reports; faults (source_hash, fault) of files that can't be read."""

    results: DataFrame
    samples: DataFrame
    reports: DataFrame
    faults: DataFrame

    def and_also(self, other: Parsed) -> Parsed:
        return Parsed(*[getattr(self, n).unionByName(getattr(other, n)) for n in ("results", "samples", "reports", "faults")])


def _parsed(files: DataFrame, results: DataFrame | None = None, samples: DataFrame | None = None, reports: DataFrame | None = None, faults: DataFrame | None = None) -> Parsed:
    none = files.where(F.lit(False)).select(F.col("hash").alias("source_hash"))
    at = lambda df, schema: _typed(none if df is None else df, schema)
    return Parsed(at(results, RESULTS), at(samples, SAMPLES), at(reports, REPORTS), at(faults, "source_hash string, fault string"))


def parse_exchange(files: DataFrame) -> Parsed:
    """Chemistry, sample and header files, each on its own; the header's work order counts for its file."""
    csv = files.where("ext = 'csv'")
    found = written(readers.raw_records(csv), "exchange-records")  # each file is read once
    chem, sample = (csv.where(F.col("header") == _names(c)) for c in (readers.CHEMISTRY, readers.SAMPLE))
    of = lambda some: found.join(some.select("hash"), "hash", "left_semi")
    rows = readers.chemistry_results(readers.delimited(chem, readers.CHEMISTRY, of(chem))).withColumn("limit_raw", F.col("rl").cast("string"))
    faults = readers.parse_faults(chem, readers.CHEMISTRY, of(chem)).union(readers.parse_faults(sample, readers.SAMPLE, of(sample)))
    faults = faults.select(F.col("hash").alias("source_hash"), "fault")
    head = readers.header_xml(files.where("ext = 'xml'"))
    reports = head.where("is_valid").select(
        F.col("hash").alias("source_hash"), F.col("lab_report_number").alias("work_order"), F.col("lab_report_number").alias("report_no"), "date_reported", "project_id"
    )
    faults = faults.union(head.where("not is_valid").select(F.col("hash").alias("source_hash"), F.lit("not_a_header")))
    return _parsed(files, rows, readers.sample_rows(readers.delimited(sample, readers.SAMPLE, of(sample))), reports, faults)


def parse_crosstab(dialect: str) -> Callable[[DataFrame], Parsed]:
    def parse(files: DataFrame) -> Parsed:
        book = written(readers.workbook(files.where(F.col("ext") != "csv")), "crosstab-books")
        cells = written(readers.grid(files.where("ext = 'csv'")).unionByName(book.where("sheet_no = 1").drop("sheet_no")), "crosstab-cells")
        rows = grids.unpivot_crosstab(cells, DIALECTS[dialect]).withColumnRenamed("file", "source_hash").withColumnRenamed("sample_date_raw", "sample_datetime_raw")
        faults = book.where("sheet is null").select(F.col("file").alias("source_hash"), F.lit("unreadable").alias("fault"))
        return _parsed(files, rows.withColumn("org", F.lit("ALS")), faults=faults)

    return parse


def parse_field(methods: DataFrame | None = None) -> Callable[[DataFrame], Parsed]:
    """Field workbooks: water sheets and dust results with their observations; methods (key) are those that field staff measure."""

    def parse(files: DataFrame) -> Parsed:
        spark = files.sparkSession
        cells = written(readers.workbook(files), "field-cells")  # each workbook is opened once
        faults = cells.where("sheet is null").select(F.col("file").alias("source_hash"), F.lit("unreadable").alias("fault")).distinct()
        cells = cells.where("sheet is not null").drop("sheet_no")
        # sheets are told apart by their names
        name = F.lower("sheet")
        front, dust, method, result = (name.contains(x) for x in ("front", "dust", "method", "result"))
        pages = workbook.front_page(cells.where(front)).select(F.col("file").alias("source_hash"), "report_no", F.col("sample_date").alias("date_reported"))
        allowed = methods if methods is not None else spark.createDataFrame([], "key string")
        water = workbook.water_sheet(cells.where(~front & ~dust & ~method), allowed).where("kind = 'result'")
        water = water.select(
            F.col("file").alias("source_hash"), F.concat("sheet", F.lit("!"), "source_ref").alias("source_ref"), F.lit("ACIRL").alias("org"), "feature_raw", "analyte_raw",
            F.lit("field").alias("method_raw"), "units_raw", "value_raw", F.col("sample_date_raw").alias("sample_datetime_raw"),
        )
        seen = workbook.dust_observations(cells.where(dust & ~result & ~method)).groupBy("file", "gauge", "block").agg(F.min("date").alias("date"), F.min("comments").alias("comments"))
        dust = workbook.dust_sheet(cells.where(dust & result)).join(seen, ["file", "gauge", "block"], "left").select(
            F.col("file").alias("source_hash"), F.concat("sheet", F.lit("!"), "source_ref").alias("source_ref"), F.lit("ACIRL").alias("org"), F.col("gauge").alias("feature_raw"),
            "analyte_raw", "value_raw", F.date_format("date", "dd/MM/yyyy").alias("sample_datetime_raw"), "comments",
        )
        return _parsed(files, water.unionByName(dust, allowMissingColumns=True), reports=pages, faults=faults)

    return parse


def built_in(field_methods: DataFrame | None = None) -> Registry:
    """A registry with the four adapters, ready to route."""
    registry = Registry()
    registry.register(Adapter("esdat", BUILT_IN_VERSION, match_exchange, parse_exchange))
    for dialect in DIALECTS:
        registry.register(Adapter(dialect, BUILT_IN_VERSION, match_crosstab(dialect), parse_crosstab(dialect)))
    registry.register(Adapter("acirl_field_xlsx", BUILT_IN_VERSION, match_field, parse_field(field_methods)))
    return registry


def parse_claimed(files: DataFrame, routed: DataFrame, registry: Registry) -> Parsed:
    """What the claimed files say, each read by its adapter. files: as `described` gives them.

    Adapters that claimed nothing aren't asked.
    """
    claimed = routed.where("state = 'claimed'").select("hash", "adapter")
    asked = {r.adapter for r in claimed.select("adapter").distinct().collect()}  # no more than there are adapters
    total = _parsed(files)
    for i in registry.ids():
        name = f"{i}/{registry.adapters[i].version}"
        if name not in asked:
            continue
        mine = files.join(claimed.where(F.col("adapter") == name).select("hash"), "hash", "left_semi").dropDuplicates(["hash"])
        got = registry.adapters[i].parse(mine)
        total = total.and_also(Parsed(got.results.withColumn("adapter", F.lit(name)), got.samples, got.reports, got.faults))
    bad = total.faults.select("source_hash").distinct()
    return Parsed(total.results.join(bad, "source_hash", "left_anti"), total.samples.join(bad, "source_hash", "left_anti"), total.reports, total.faults)
