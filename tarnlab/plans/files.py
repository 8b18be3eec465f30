"""Queries of file sources and grids: the tables written out as laboratory files and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import grids, reviews
from ..sources import files as src
from ..sources import readers
from .registry import query
from .roles import Roles


def chemistry_files(r: Roles) -> DataFrame:
    """One exchange file for each customer with orders: a line for each order."""
    k, s = F.col("o_orderkey"), lambda c: c.cast("string")
    code = F.concat(F.lit("XX"), F.lpad(s(F.col("o_custkey")), 7, "0"), F.lit("001"))
    code = F.when(k % 10 == 0, F.concat(F.lit("XX"), F.lpad(s(F.col("o_custkey")), 7, "0"), F.lit("_YY1234567"))).otherwise(code)
    fields = {
        "SampleCode": code, "ChemCode": F.when(k % 2 == 0, "7440-38-2").otherwise("EC"), "OriginalChemName": F.concat(F.lit('"Name, '), s(k), F.lit('"')),
        "Prefix": F.when(k % 3 == 0, "<").otherwise(""), "Result": s(F.floor("o_totalprice")), "Result_Unit": F.lit("mg/L"),
        "Method_Name": F.when(k % 5 != 0, F.concat(F.lit("EA"), s(k % 7))).otherwise(""), "Analysed_Date": F.date_format("o_orderdate", "dd MMM yyyy"),
    }
    line = F.concat_ws(",", *[fields.get(c, F.lit("")) for c in readers.CHEMISTRY])
    o = r.table("orders").select("o_custkey", k, line.alias("line"))
    g = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "line"))).alias("x"))
    content = F.concat(F.lit("﻿" + ",".join(readers.CHEMISTRY) + "\r\n"), F.array_join(F.transform("x", lambda x: x["line"]), "\r\n"))
    return g.select(F.col("o_custkey").cast("string").alias("hash"), content.cast("binary").alias("content"))


@query(
    "a06_exchange_files",
    """SELECT CAST(o_custkey AS VARCHAR) AS source_hash, 'Name, ' || o_orderkey AS analyte_raw, 'XX' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS work_order, CASE WHEN o_orderkey % 10 = 0 THEN 'NCP' END AS sample_type,
  CASE WHEN o_orderkey % 2 = 0 THEN '7440-38-2' END AS cas_number, CASE WHEN o_orderkey % 5 <> 0 THEN 'EA' || (o_orderkey % 7) END AS method_raw, floor(o_totalprice) AS value_num, o_orderkey % 3 <> 0 AS quantified,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS analysed_date FROM orders""",
)
def exchange_files(r: Roles) -> DataFrame:
    out = readers.chemistry_results(readers.delimited(chemistry_files(r), readers.CHEMISTRY))
    return out.select(
        "source_hash", "analyte_raw", "work_order", "sample_type", "cas_number", "method_raw", F.col("parsed.value_num").alias("value_num"),
        F.col("parsed.quantified").alias("quantified"), F.col("analysed_date").cast("string").alias("analysed_date"),
    )


@query("a10_grid_cells", "SELECT count(*) AS n_files, sum(n * 6 + (n - z) + (n - l) + 18) AS n_cells FROM (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderkey % 3 <> 0) AS z, count(*) FILTER (o_orderkey % 5 = 0) AS l FROM orders GROUP BY 1)")
def grid_cells(r: Roles) -> DataFrame:
    g = readers.grid(chemistry_files(r))
    return g.agg(F.countDistinct("file").alias("n_files"), F.count("*").alias("n_cells"))


def sheet_cells(lines: DataFrame, file: Column, sheet: str, fixed: list, column, part, value) -> DataFrame:
    """Cells of a sheet for each supplier: fixed ones, those of each line number (column), of each part (part), and one of each of both (value).

    Orders' lines move once, by sheet, before they become cells: what is asked of a sheet later finds all of it in one task.
    """
    cell = lambda r, c, v: F.struct(r.cast("long").alias("r"), c.cast("int").alias("c"), v.alias("v"))
    n = F.col("l_linenumber")
    li = lines.select(file.alias("file"), "l_partkey", "l_linenumber", "l_quantity").repartition("file")
    li = li.groupBy("file", "l_partkey", "l_linenumber").agg(F.sum("l_quantity").cast("long").alias("q"))
    w = Window.partitionBy("file").orderBy("l_partkey", "l_linenumber")
    li = li.withColumns({"_file": F.row_number().over(w), "_part": F.row_number().over(Window.partitionBy("file", "l_partkey").orderBy("l_linenumber")), "_ns": F.collect_set("l_linenumber").over(Window.partitionBy("file"))})
    own = F.array(cell(*value(n, F.col("q"))))
    own = F.when(F.col("_part") == 1, F.concat(own, F.array(*[cell(*x) for x in part]))).otherwise(own)
    head = F.concat(F.array(*[cell(*[F.lit(x) for x in f]) for f in fixed]), F.flatten(F.transform("_ns", lambda x: F.array(*[cell(*y) for y in column(x)]))))
    x = F.explode(F.when(F.col("_file") == 1, F.concat(own, head)).otherwise(own))
    return li.select("file", F.lit(sheet).alias("sheet"), x.alias("x")).select("file", "sheet", "x.*")


def crosstab_cells(r: Roles) -> DataFrame:
    """A crosstab for each supplier: parts are analytes with a method heading each, line numbers are samples."""
    s = lambda c: c.cast("string")
    at, key = 10 + 2 * F.col("l_partkey"), s(F.col("l_partkey"))
    fixed = [(1, 1, "Matrix: WATER"), (2, 5, "ALS Sample number:"), (3, 5, "Client sample ID (1st):"), *[(4, c, v) for c, v in enumerate(("Analyte", "CAS Number", "Unit", "LOR"), 1)]]
    column = lambda n: [(F.lit(2), n + 5, F.concat(F.lit("S"), s(n))), (F.lit(3), n + 5, F.concat(F.lit("P"), s(n)))]
    part = [(at, F.lit(1), F.concat(F.lit("EA: "), key)), (at + 1, F.lit(1), F.concat(F.lit("part "), key)), (at + 1, F.lit(3), F.lit("mg/L"))]
    return sheet_cells(r.table("lineitem"), F.concat(F.lit("s"), s(F.col("l_suppkey"))), "", fixed, column, part, lambda n, q: (at + 1, n + 5, s(q)))


@query(
    "i01_unpivot_crosstab",
    """SELECT 's' || l_suppkey AS file, 'part ' || l_partkey AS analyte_raw, 'EA: ' || l_partkey AS method_raw, 'mg/L' AS units_raw, 'S' || l_linenumber AS lab_sample_id, 'P' || l_linenumber AS feature_raw,
  CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS value_raw, 'r' || (11 + 2 * l_partkey) || 'c' || (l_linenumber + 5) AS source_ref FROM lineitem GROUP BY l_suppkey, l_partkey, l_linenumber""",
)
def unpivot_crosstab(r: Roles) -> DataFrame:
    out = grids.unpivot_crosstab(crosstab_cells(r))
    return out.select("file", "analyte_raw", "method_raw", "units_raw", "lab_sample_id", "feature_raw", "value_raw", "source_ref")


@query(
    "a12_encoding_fallback",
    "SELECT doc_id, md5(text) AS text_md5 FROM documents",
)
def encoding_fallback(r: Roles) -> DataFrame:
    """Whole documents as UTF-8 or, where Latin-1 can hold them, Latin-1 bytes: the decoder finds the text again."""
    t = F.col("text")
    latin = t.rlike(r"^[\x00-\xff]*$") & t.rlike(r"[\xa0-\xff]") & (F.col("doc_id") % 2 == 0)
    content = F.when(latin, F.encode(F.when(latin, t), "ISO-8859-1")).otherwise(F.encode(t, "UTF-8"))
    return r.table("documents").select("doc_id", F.md5(src.decoded(content)).alias("text_md5"))


@query("c26_asset_types", "SELECT CASE WHEN o_orderkey % 3 = 1 THEN 'crosstab' WHEN o_orderkey % 3 = 2 THEN 'old' ELSE 'Chemical analysis' END AS type, count(*) AS n FROM orders GROUP BY 1")
def asset_types(r: Roles) -> DataFrame:
    from .scalars import filename

    f = r.table("orders").select(filename().alias("filename"))
    kind = F.lit("Chemical analysis")
    for pattern, name in reversed((("_XTAB", "crosstab"), ("-old", "old"))):
        kind = F.when(F.col("filename").rlike(pattern), name).otherwise(kind)
    return f.groupBy(kind.alias("type")).agg(F.count("*").alias("n"))


@query("j13_line_classes", "SELECT CASE WHEN p_partkey % 5 = 0 THEN 'comment' WHEN p_partkey % 5 = 1 THEN 'site_metadata_label' WHEN p_partkey % 5 = 2 AND p_size % 2 = 0 THEN 'aroclor_surrogate_percent' WHEN p_size % 3 = 0 THEN 'heading' WHEN p_size % 7 = 0 THEN 'transcription_label' ELSE 'result' END AS kind, count(*) AS n FROM part GROUP BY 1")
def line_classes(r: Roles) -> DataFrame:
    k, z = F.col("p_partkey") % 5, F.col("p_size")
    label = F.when(k == 0, "Comments: none").when(k == 1, "Sampled by").when(k == 2, "Aroclor 1016").otherwise(F.col("p_name"))
    unit = F.when((k == 2) & (z % 2 == 0), "%").otherwise("mg/L")
    kind = grids.classify_line(label, unit, F.when(z % 3 == 0, 0).otherwise(2), z % 7 != 0)
    return r.table("part").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("j14_repaired_units", "SELECT uuid, CASE WHEN rl_low > 40 THEN '°C' WHEN rl_low > 30 THEN 'pH' WHEN rl_low > 20 THEN 'µS/cm' ELSE units END AS units FROM lab_method")
def repaired_units(r: Roles) -> DataFrame:
    rl = F.col("rl_low")
    label = F.when(rl > 40, "Temperature (field)").otherwise(F.col("name"))
    unit = F.when(rl > 40, "deg").when(rl > 30, "pH Units").when(rl > 20, "25 µS/cm").otherwise(F.col("units"))
    return r.lab_method.select("uuid", text.repair_units(label, unit).alias("units"))


@query("n12_analyte_review", "SELECT name, organisation, count(*) AS n_rows, string_agg(uuid, ',' ORDER BY uuid) AS source_ref FROM lab_method WHERE uuid_analyte IS NULL GROUP BY 1, 2")
def analyte_review(r: Roles) -> DataFrame:
    rows = r.lab_method.where("uuid_analyte is null").select("name", "organisation", F.col("uuid").alias("source_ref"), F.lit(None).cast("array<string>").alias("candidates"))
    return reviews.review_rows(rows, ["name", "organisation"]).drop("candidates")
