"""Queries of single operators: adapters' marks, scalar rules, registry lookups, units, reviews and edits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, units, values
from ..operators import assemble as asm
from ..operators import event, grids
from ..operators import reconcile as rc
from ..operators import registry as reg
from ..operators import resolve as rs
from ..operators import reviews as rv
from ..operators import workbook as wb
from ..sources import adapters, readers
from ..sources import files as src
from ..warehouse import ingest, store
from ..warehouse import registry as edits
from .files import sheet_cells
from .registry import query
from .roles import Roles


def s(c):
    return F.col(c).cast("string")


# sources


@query(
    "a03_file_meta",
    """SELECT doc_id, sha256(text) AS hash, strlen(text) AS size, 'csv' AS ext, 'XX' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS work_order, CASE WHEN doc_id % 3 = 0 THEN doc_id % 9 END AS revision FROM documents""",
)
def file_meta(r: Roles) -> DataFrame:
    """Names and hashes of files: here each document is a file's content."""
    name = F.concat(F.lit("PROJ.XX"), F.lpad(s("doc_id"), 7, "0"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("_"), (F.col("doc_id") % 9).cast("string"))).otherwise(""), F.lit(".Chemistry.CSV"))
    f = r.table("documents").select("doc_id", name.alias("filename"), F.encode("text", "UTF-8").alias("content"))
    return f.select(
        "doc_id", F.sha2("content", 256).alias("hash"), F.length("content").cast("long").alias("size"), F.lower(F.regexp_extract("filename", r"\.([^.]+)$", 1)).alias("ext"),
        text.guess_work_order(F.col("filename")).alias("work_order"), text.guess_revision(F.col("filename")).cast("long").alias("revision"),
    )


@query("a13_damage", "SELECT doc_id, CAST(doc_id % 3 + length(text) - length(replace(text, '�', '')) AS INTEGER) AS n FROM documents")
def damage(r: Roles) -> DataFrame:
    """Replacement characters put into whole texts are counted again, beside those that stand there."""
    t = F.concat("text", F.repeat(F.lit(" <ef><bf><bd>"), (F.col("doc_id") % 3).cast("int")))
    return r.table("documents").select("doc_id", src.damage(t).cast("int").alias("n"))


def delimited_files(r: Roles) -> DataFrame:
    """A file for each supplier: columns in one of two orders, quoted line breaks, 70 columns more; some lack a column or never close a quote."""
    k = F.col("s_suppkey")
    more = ",".join(f"x{i}" for i in range(70))
    body = F.concat(F.lit('"'), "s_name", F.lit('\n""'), F.lit('q""",'), s("s_nationkey"))
    turned = F.concat(s("s_nationkey"), F.lit(',"'), "s_name", F.lit('\n""q"""'))
    tail = "," * 70
    content = F.when(k % 7 == 0, F.lit("name,other\na,b\n")).when(k % 7 == 1, F.lit('"name,nation\n1,2\n')).when(k % 7 == 2, F.lit(""))
    content = content.when(k % 2 == 0, F.concat(F.lit(f"name,nation,{more}\r\n"), body, F.lit(f"{tail}\r\n\r\n")))
    content = content.otherwise(F.concat(F.lit(f"nation,name,{more}\r\n"), turned, F.lit(f"{tail}\r\n")))
    return r.table("supplier").select(s("s_suppkey").alias("hash"), content.cast("binary").alias("content"))


@query("a07_header_by_name", "SELECT CAST(s_suppkey AS VARCHAR) AS hash, 'r2' AS source_ref, s_name || chr(10) || '\"q\"' AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier WHERE s_suppkey % 7 > 2")
def header_by_name(r: Roles) -> DataFrame:
    return readers.delimited(delimited_files(r), ("name", "nation"))


@query("a08_parse_faults", "SELECT CAST(s_suppkey AS VARCHAR) AS hash, CASE s_suppkey % 7 WHEN 0 THEN 'missing_columns' WHEN 1 THEN 'corrupt' ELSE 'no_header' END AS fault, CASE WHEN s_suppkey % 7 = 0 THEN 'nation' END AS missing FROM supplier WHERE s_suppkey % 7 <= 2")
def parse_faults(r: Roles) -> DataFrame:
    return readers.parse_faults(delimited_files(r), ("name", "nation")).select("hash", "fault", F.array_join("missing", ",").alias("missing"))


@query("a09_header_files", "SELECT CAST(c_custkey AS VARCHAR) AS hash, c_custkey % 4 <> 0 AS is_valid, CASE WHEN c_custkey % 9 <> 5 THEN c_name || ' & <co>' END AS lab_report_number, c_mktsegment AS lab_name FROM customer")
def header_files(r: Roles) -> DataFrame:
    """Headers with either kind of quotes, entities, prefixes and comments that hold a decoy."""
    k = F.col("c_custkey")
    space = F.when(k % 4 == 0, "http://example.org/x").otherwise("http://www.escis.com.au/2013/XML")
    number = F.when(k % 9 == 5, "").otherwise(F.concat("c_name", F.lit(" &amp; &lt;co&gt;")))
    p, q = F.when(k % 2 == 0, "e:").otherwise(""), F.when(k % 3 == 0, "'").otherwise('"')
    decl = F.concat(F.lit(" xmlns"), F.when(k % 2 == 0, ":e").otherwise(""), F.lit("='"), space, F.lit("'"))
    xml = F.concat(F.lit("<?xml version='1.0'?><!-- <LabReport Lab_Name='no'/> --><"), p, F.lit("ESdat"), decl, F.lit("><"), p, F.lit("LabReport Lab_Report_Number="), q, number, q, F.lit(" Lab_Name="), q, F.col("c_mktsegment"), q, F.lit("/></"), p, F.lit("ESdat>"))
    f = r.table("customer").select(s("c_custkey").alias("hash"), xml.cast("binary").alias("content"))
    return readers.header_xml(f).select("hash", "is_valid", "lab_report_number", "lab_name")


# adapters


def claimed_files(r: Roles) -> DataFrame:
    """Orders as files of every kind an adapter looks at."""
    k = F.col("o_orderkey") % 10
    chem, sample = ",".join(readers.CHEMISTRY), ",".join(readers.SAMPLE)
    content = (
        F.when(k == 0, f"﻿{chem}\r\n").when(k == 1, F.lit('"' + '","'.join(readers.SAMPLE) + '"\n')).when(k == 2, chem.lower()).when(k == 3, f"{sample},More")
        .when(k == 4, F.lit("Matrix: WATER\r\n\r\nWorkgroup: 1\r\n")).when(k == 5, F.lit("Client - Matrix: SOIL\n" + "," * 3000 + "\nWorkgroup: 2"))
        .when(k == 6, F.lit("Matrix: WATER\nno group\n")).when(k == 7, F.lit("<ESdat xmlns='http://www.escis.com.au/2013/XML'/>")).otherwise("Workgroup: 3\nMatrix: late\n")
    )
    ext = F.when(k == 7, "xml").when(k == 9, "txt").otherwise("csv")
    f = r.table("orders").select(F.concat(F.lit("h"), s("o_orderkey")).alias("hash"), F.concat(s("o_orderkey"), F.lit("."), ext).alias("filename"), ext.alias("ext"), content.cast("binary").alias("content"))
    return adapters.described(f.withColumn("peek", F.decode(F.substring("content", 1, src.PEEK_BYTES), "ISO-8859-1")))


@query("c07_exchange_match", "SELECT 'h' || o_orderkey AS hash, CASE WHEN o_orderkey % 10 IN (0, 1, 7) THEN 'exact' END AS tier FROM orders")
def exchange_match(r: Roles) -> DataFrame:
    f = claimed_files(r)
    return f.select("hash", adapters.match_exchange(f).alias("tier"))


@query("c08_crosstab_match", "SELECT 'h' || o_orderkey AS hash, CASE WHEN o_orderkey % 10 = 4 THEN 'format' END AS xtab, CASE WHEN o_orderkey % 10 = 5 THEN 'format' END AS enmrg FROM orders")
def crosstab_match(r: Roles) -> DataFrame:
    f = claimed_files(r)
    return f.select("hash", adapters.match_crosstab("als_xtab")(f).alias("xtab"), adapters.match_crosstab("als_enmrg")(f).alias("enmrg"))


@query("c09_field_match", "SELECT p_partkey, CASE WHEN p_size % 3 > 0 AND p_partkey % 2 = 0 THEN 'format' END AS tier FROM part")
def field_match(r: Roles) -> DataFrame:
    f = r.table("part").select("p_partkey", F.when(F.col("p_size") % 3 == 1, "xls").when(F.col("p_size") % 3 == 2, "xlsx").otherwise("csv").alias("ext"), (F.col("p_partkey") % 2 == 0).alias("is_field_book"))
    return f.select("p_partkey", adapters.match_field(f).alias("tier"))


def marked_cells(r: Roles) -> DataFrame:
    """A sheet for each part with a mark in the row of its size."""
    k = F.col("p_partkey") % 4
    v = F.when(k == 0, " Units ").when(k == 1, "Units of").when(k == 2, "gauge no.").otherwise("x")
    base = r.table("part").select(s("p_partkey").alias("file"), F.lit("S").alias("sheet"), F.col("p_size").alias("r"), F.lit(2).alias("c"), v.alias("v"))
    second = r.table("part").where("p_partkey % 3 = 0").select(s("p_partkey"), F.lit("S"), F.lit(20), F.lit(3), F.lit("Insoluble solids"))
    return base.union(second)


@query("c10_units_marker", "SELECT CAST(p_partkey AS VARCHAR) AS file, 'S' AS sheet FROM part WHERE p_partkey % 4 = 0 AND p_size <= 15")
def units_marker(r: Roles) -> DataFrame:
    return adapters.has_units_marker(marked_cells(r))


@query("c11_dust_marker", "SELECT CAST(p_partkey AS VARCHAR) AS file, 'S' AS sheet FROM part WHERE p_partkey % 4 = 2 AND p_partkey % 3 = 0 AND p_size <= 20")
def dust_marker(r: Roles) -> DataFrame:
    return adapters.has_dust_marker(marked_cells(r))


@query("c25_field_shaped", "WITH n AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '2400-' WHEN 1 THEN 'report 2400' WHEN 2 THEN '12400-' ELSE '24-00' END || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') || '-01.xlsx' AS name FROM orders) SELECT o_orderkey, regexp_matches(' ' || name, '[^0-9]2400-?[0-9]{4}') AS shaped FROM n")
def field_shaped(r: Roles) -> DataFrame:
    k, tail = F.col("o_orderkey") % 4, F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0")
    name = F.concat(F.when(k == 0, "2400-").when(k == 1, "report 2400").when(k == 2, "12400-").otherwise("24-00"), tail, F.lit("-01.xlsx"))
    return r.table("orders").select("o_orderkey", adapters.is_field_shaped(name).alias("shaped"))


@query("c02_ignore_rule", "WITH f AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'a.bak' WHEN 1 THEN 'a.tmp' WHEN 2 THEN '.DS_Store' ELSE 'a.csv' END AS name, o_orderkey % 7 AS size FROM orders), ignored(ext) AS (VALUES ('bak'), ('tmp'), ('ds_store')) SELECT o_orderkey, CASE WHEN ext IS NOT NULL THEN 'ignored_extension:' || ext WHEN name = '.DS_Store' THEN 'ds_store_file' WHEN size = 0 THEN 'empty_file' END AS reason FROM f LEFT JOIN ignored ON name LIKE '_%.' || ext")
def ignore_rule(r: Roles) -> DataFrame:
    k = F.col("o_orderkey") % 6
    ext = F.when(k == 0, "bak").when(k == 1, "tmp").otherwise("csv")
    return r.table("orders").select("o_orderkey", src.ignore_reason(ext, F.when(k == 2, ".DS_Store").otherwise("a.csv"), F.col("o_orderkey") % 7).alias("reason"))


# scalar rules


@query("c12_is_true", "SELECT uuid, coalesce(quantified, FALSE) AS yes FROM analysis")
def is_true(r: Roles) -> DataFrame:
    return r.analysis.select("uuid", values.is_true(F.col("quantified")).alias("yes"))


@query("c13_alias_live", "SELECT s.uuid AS sample, a.uuid AS alias, (a.date_start IS NULL OR a.date_start <= CAST(s.datetime AS DATE) OR s.datetime IS NULL) AND (a.date_end IS NULL OR a.date_end >= CAST(s.datetime AS DATE) OR s.datetime IS NULL) AS live FROM sample s JOIN feature_alias a ON s.uuid_feature_alias = a.uuid")
def alias_live(r: Roles) -> DataFrame:
    a = r.feature_alias.select(F.col("uuid").alias("alias"), "date_start", "date_end")
    rows = r.sample.select(F.col("uuid").alias("sample"), F.to_date("datetime").alias("day"), "uuid_feature_alias").join(a, F.col("uuid_feature_alias") == F.col("alias"))
    return rows.select("sample", "alias", values.live(F.col("date_start"), F.col("date_end"), F.col("day")).alias("live"))


@query("c15_provably_distinct", "SELECT i.row, coalesce(i.datetime <> e.datetime, FALSE) AS other FROM incoming i JOIN stored e ON i.source_ref = e.uuid")
def provably_distinct(r: Roles) -> DataFrame:
    e = r.stored.select(F.col("uuid").alias("e"), F.col("datetime").alias("e_at"))
    rows = r.incoming.join(e, F.col("source_ref") == F.col("e"))
    return rows.select("row", values.provably_distinct(F.col("datetime"), F.col("e_at")).alias("other"))


@query("c16_values_equal", "SELECT i.row, i.quantified IS NOT DISTINCT FROM e.quantified AND CASE WHEN i.value IS NOT NULL AND e.value IS NOT NULL THEN abs(i.value - e.value) <= 1e-9 * greatest(1.0, abs(i.value), abs(e.value)) WHEN i.value IS NULL AND e.value IS NULL THEN i.value_chr IS NOT DISTINCT FROM e.value_chr ELSE FALSE END AS same FROM incoming i JOIN stored e ON i.source_ref = e.uuid")
def values_equal(r: Roles) -> DataFrame:
    e = r.stored.select(F.col("uuid").alias("e"), F.col("value").alias("v"), F.col("value_chr").alias("t"), F.col("quantified").alias("q"))
    rows = r.incoming.join(e, F.col("source_ref") == F.col("e"))
    return rows.select("row", values.values_equal(F.col("value"), F.col("value_chr"), F.col("quantified"), F.col("v"), F.col("t"), F.col("q")).alias("same"))


@query("c17_field_methods", "SELECT uuid, coalesce(method IN ('field', 'EN67 - Client Supplied Data'), FALSE) AS field FROM lab_method")
def field_methods(r: Roles) -> DataFrame:
    return r.lab_method.select("uuid", values.is_field(F.col("method")).alias("field"))


@query("c24_target_is_self", "SELECT a.uuid, a.alias_key = lower(f.name) AS is_self FROM feature_alias a JOIN feature f ON a.uuid_feature = f.uuid")
def target_is_self(r: Roles) -> DataFrame:
    f = r.feature.select(F.col("uuid").alias("f"), F.col("name").alias("f_name"))
    return r.feature_alias.join(f, F.col("uuid_feature") == F.col("f")).select("uuid", edits.target_is_self(F.col("alias_key"), F.col("f_name")).alias("is_self"))


@query("l02_valid_units", "WITH known(u) AS (VALUES ('mg/L'), ('ug/L'), ('g/L'), ('uS/cm'), ('mS/cm'), ('pH'), ('NTU'), ('mm')) SELECT uuid, units, CASE WHEN units IS NOT NULL THEN units IN (SELECT u FROM known) END AS valid FROM (SELECT uuid, CASE WHEN units = 'g/L' THEN 'g/L!' ELSE units END AS units FROM lab_method)")
def valid_units(r: Roles) -> DataFrame:
    u = F.when(F.col("units") == "g/L", "g/L!").otherwise(F.col("units"))
    return r.lab_method.select("uuid", u.alias("units"), units.is_valid(u).alias("valid"))


@query("l03_compatible_units", "WITH u(u, d) AS (VALUES ('mg/L', 'mass/volume'), ('ug/L', 'mass/volume'), ('g/L', 'mass/volume'), ('uS/cm', 'conductivity'), ('mS/cm', 'conductivity')) SELECT m.uuid, CASE WHEN m.units IS NOT NULL AND a.units IS NOT NULL THEN coalesce(x.d = y.d, FALSE) END AS compatible FROM lab_method m JOIN analyte a ON m.uuid_analyte = a.uuid LEFT JOIN u x ON x.u = m.units LEFT JOIN u y ON y.u = a.units")
def compatible_units(r: Roles) -> DataFrame:
    a = r.analyte.select(F.col("uuid").alias("a"), F.col("units").alias("a_units"))
    return r.lab_method.join(a, F.col("uuid_analyte") == F.col("a")).select("uuid", units.compatible(F.col("units"), F.col("a_units")).alias("compatible"))


@query("l04_canonical_units", "WITH s AS (SELECT p_partkey, ['pH', 'pH Unit', 'pH_Units', 'mg/L'][1 + p_partkey % 4] AS said FROM part) SELECT p_partkey, CASE WHEN said IN ('pH', 'pH Unit', 'pH_Units') THEN '1' ELSE said END AS unit FROM s")
def canonical_units(r: Roles) -> DataFrame:
    said = F.get(F.array(*[F.lit(x) for x in ("pH", "pH Unit", "pH_Units", "mg/L")]), (F.col("p_partkey") % 4).cast("int"))
    return r.table("part").select("p_partkey", units.canonical(said).alias("unit"))


@query(
    "l07_converted_analyses",
    """WITH u(u, d, f) AS (VALUES ('mg/L', 'c', 1e-3), ('ug/L', 'c', 1e-6), ('g/L', 'c', 1.0), ('uS/cm', 's', 1e-4), ('mS/cm', 's', 0.1)),
x AS (SELECT a.uuid, a.value, m.units IS NOT DISTINCT FROM an.units AS same, x.d = y.d AS fits, x.f / y.f AS k, a.revision FROM analysis a JOIN lab_method m ON a.uuid_lab = m.uuid JOIN analyte an ON m.uuid_analyte = an.uuid LEFT JOIN u x ON m.units = x.u LEFT JOIN u y ON an.units = y.u WHERE a.revision <> 6)
SELECT CASE WHEN same THEN 'same_unit' WHEN fits THEN 'converted' ELSE 'incompatible' END AS status, count(*) AS n, round(sum(CASE WHEN same THEN value WHEN fits THEN value * k END), 3) AS total FROM x GROUP BY 1""",
)
def converted_analyses(r: Roles) -> DataFrame:
    done = r.analysis.where("revision = 6").select("uuid")
    out = edits.converted_analyses(r.analysis, r.lab_method, r.analyte, done)
    return out.groupBy("status").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query("g07_find_cells", "SELECT CAST(p_partkey AS VARCHAR) AS file, p_size AS r FROM part WHERE p_partkey % 4 IN (0, 1)")
def find_cells(r: Roles) -> DataFrame:
    return grids.find_cells(marked_cells(r), "^units").select("file", "r")


@query("i02_beside", "SELECT CAST(o_custkey AS VARCHAR) AS file, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS found FROM orders GROUP BY 1")
def beside(r: Roles) -> DataFrame:
    f = lambda df, c, v: df.select(s("o_custkey").alias("file"), F.lit("").alias("sheet"), F.lit(7).alias("r"), c.cast("long").alias("c"), v.alias("v"))
    o = r.table("orders")
    cells = f(o.select("o_custkey").distinct(), F.lit(0), F.lit("Mark:")).union(f(o, F.col("o_orderkey") + 1, s("o_orderkey")))
    return grids.beside(cells, "^mark").select("file", F.array_join("values", ",").alias("found"))


@query("f14_occurrence", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS n FROM orders")
def occurrence(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", grids.occurrence(["o_custkey"], "o_orderkey").alias("n"))


def water_cells(r: Roles) -> DataFrame:
    """A water sheet for each supplier: line numbers are samples, parts are analytes, a date cell carries over."""
    fixed = [(5, 1, "Site Name"), (5, 2, "Units"), (4, 1, "Date sampled"), (4, 3, "45802")]
    column = lambda n: [(F.lit(5), n + 2, F.concat(F.lit("P"), n.cast("string")))]
    at = F.col("l_partkey") + 10
    part = [(at, F.lit(1), F.concat(F.lit("part "), s("l_partkey"))), (at, F.lit(2), F.lit("mg/L"))]
    return sheet_cells(r.table("lineitem"), s("l_suppkey"), "W", fixed, column, part, lambda n, q: (at, n + 2, F.when(q % 10 == 0, "--").otherwise(q.cast("string"))))


@query(
    "i04_water_sheet",
    """SELECT CAST(l_suppkey AS VARCHAR) AS file, CASE WHEN q % 10 = 0 THEN 'not_analysed' ELSE 'result' END AS kind, 'part ' || l_partkey AS analyte_raw, 'P' || l_linenumber AS feature_raw, '25/05/2025' AS sample_date_raw,
  CASE WHEN q % 10 = 0 THEN '--' ELSE CAST(q AS VARCHAR) END AS value_raw FROM (SELECT l_suppkey, l_partkey, l_linenumber, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem WHERE l_partkey % 5 <> 0 GROUP BY 1, 2, 3)""",
)
def water_sheet(r: Roles) -> DataFrame:
    allowed = r.table("part").where("p_partkey % 5 <> 0").select(text.method_key(F.concat(F.lit("part "), s("p_partkey"))).alias("key"))
    out = wb.water_sheet(water_cells(r), allowed).where("kind in ('result', 'not_analysed')")
    return out.select("file", "kind", "analyte_raw", "feature_raw", "sample_date_raw", "value_raw")


@query("i05_dust_sheet", "SELECT CAST(s_suppkey AS VARCHAR) AS file, 'G' || n AS gauge, CAST(1 AS BIGINT) AS block, a AS analyte_raw, CAST(s_suppkey % 90 + n AS VARCHAR) AS value_raw FROM supplier, (VALUES (1, 'INSOLUBLE SOLIDS'), (2, 'INSOLUBLE SOLIDS'), (1, 'ASH'), (2, 'ASH')) v(n, a)")
def dust_sheet(r: Roles) -> DataFrame:
    """Two gauges and two analytes a sheet; the second analyte's values stand one column further."""
    v = lambda n: (F.col("s_suppkey") % 90 + n).cast("string")
    cells = [(1, 1, F.lit("GAUGE NO")), (1, 2, F.lit("INSOLUBLE SOLIDS")), (1, 4, F.lit("ASH"))]
    for n in (1, 2):
        cells += [(1 + n, 1, F.lit(f"G{n}")), (1 + n, 2, v(n)), (1 + n, 5, v(n))]
    x = F.explode(F.array(*[F.struct(F.lit(a).alias("r"), F.lit(b).alias("c"), t.alias("v")) for a, b, t in cells]))
    g = r.table("supplier").select(s("s_suppkey").alias("file"), F.lit("D").alias("sheet"), x.alias("x")).select("file", "sheet", "x.*")
    return wb.dust_sheet(g).select("file", "gauge", F.col("block").cast("long").alias("block"), "analyte_raw", "value_raw")


@query("i07_front_page", "SELECT CAST(s_suppkey AS VARCHAR) AS file, 'R ' || s_suppkey AS report_no, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS sampled_by, CASE WHEN s_suppkey % 3 <> 0 THEN '0' || (s_suppkey % 9) || '/05/2025' END AS sample_date FROM supplier")
def front_page(r: Roles) -> DataFrame:
    """A key without a cell and a key in two cells say nothing."""
    k = F.col("s_suppkey")
    day = F.concat(F.lit("0"), (k % 9).cast("string"), F.lit("/05/2025"))
    cells = [(1, 1, F.lit("Report  No:")), (1, 3, F.concat(F.lit("R  "), s("s_suppkey"))), (1, 4, F.lit("no")), (2, 2, F.when(k % 4 != 0, "SAMPLED BY:")), (2, 3, F.concat("s_name", F.lit(" & others"))),
             (3, 1, F.lit("SAMPLE DATE:")), (3, 2, day), (9, 1, F.when(k % 3 == 0, "sample date:")), (9, 2, F.lit("x"))]
    x = F.explode(F.array(*[F.struct(F.lit(a).alias("r"), F.lit(b).alias("c"), t.alias("v")) for a, b, t in cells]))
    g = r.table("supplier").select(s("s_suppkey").alias("file"), F.lit("Front").alias("sheet"), x.alias("x")).select("file", "sheet", "x.*")
    return wb.front_page(g)


# lookups


@query("d03_live_features", "SELECT s.uuid, f.uuid AS uuid_feature FROM sample s JOIN feature_alias a ON s.uuid_feature_alias = a.uuid JOIN feature f ON a.uuid_feature = f.uuid WHERE s.datetime IS NULL OR ((f.date_end IS NULL OR f.date_end >= CAST(s.datetime AS DATE)) AND (a.date_start IS NULL OR a.date_start <= CAST(s.datetime AS DATE)) AND (a.date_end IS NULL OR a.date_end >= CAST(s.datetime AS DATE)))")
def live_features(r: Roles) -> DataFrame:
    keys = r.feature_alias.select(F.col("uuid").alias("a"), F.col("alias_key").alias("key"))
    rows = r.sample.select(F.col("uuid").alias("row"), F.to_date("datetime").alias("day"), "uuid_feature_alias").join(keys, F.col("uuid_feature_alias") == F.col("a"))
    m = rs.alias_matches(rows.select("row", "key", "day", "a"), r.feature_alias, r.feature).where("fa_uuid = a and fa_uuid_feature is not null and f_uuid is not null")
    return m.where("is_live and feature_live").select(F.col("row").alias("uuid"), F.col("fa_uuid_feature").alias("uuid_feature"))


@query("d10_method_candidates", "SELECT uuid AS row, uuid AS uuid_lab FROM (SELECT min(uuid) OVER (PARTITION BY name, organisation, method) AS least, uuid FROM lab_method) WHERE uuid = least")
def method_candidates(r: Roles) -> DataFrame:
    """Each method's own name, organisation and method find it, or the least of those alike."""
    rows = r.lab_method.select(F.col("uuid").alias("row"), F.col("name").alias("analyte_raw"), F.col("organisation").alias("org"), F.col("method").alias("method_raw"))
    return rs.resolve_methods(rows, r.lab_method).where("row = uuid_lab").select("row", "uuid_lab")


SIDE = "CASE WHEN {o} = 'ALS' AND coalesce({m} NOT IN ('field', 'EN67 - Client Supplied Data'), TRUE) THEN 'als' WHEN {o} = 'ACIRL' AND {m} IS NULL THEN 'copy' END"


@query(
    "d14_twins",
    f"""WITH b AS (SELECT i.row, {SIDE.format(o='i.organisation', m='i.method')} AS a, {SIDE.format(o='e.organisation', m='e.method')} AS z, e.uuid, i.datetime AS t, e.datetime AS u FROM incoming i JOIN stored e ON i.point = e.point AND i.date = e.date AND i.uuid_analyte = e.uuid_analyte)
SELECT row, CASE a WHEN 'copy' THEN 'skip' ELSE 'delete_twin' END AS action, arg_min(uuid, (CASE WHEN t = u THEN 0 ELSE 1 END, uuid)) AS twin FROM b WHERE a <> z GROUP BY row, a HAVING NOT bool_and(coalesce(t <> u, FALSE))""",
)
def twins(r: Roles) -> DataFrame:
    """Twins of laboratory results and their transcriptions, whichever of them comes, unless their instants prove them others."""
    kind = values.lab_kind(F.lit(True), F.col("method"), F.col("organisation"))
    out = rc.twin_supersession(r.incoming.withColumn("kind", kind), r.stored.withColumn("kind", kind))
    return out.where("action <> 'none'").select("row", "action", "twin")


@query("d23_dependents", "SELECT m.uuid, 'analysis' AS tbl, 'uuid_lab' AS field, a.uuid AS uuid_row FROM lab_method m JOIN analysis a ON a.uuid_lab = m.uuid WHERE m.rl_low > 25")
def dependents(r: Roles) -> DataFrame:
    return edits.dependents(lambda n: getattr(r, n), "lab_method", r.lab_method.where("rl_low > 25"))


@query("j06_structure", "SELECT f.uuid, f.site, substr(f.name, length(f.site) + 2) AS point FROM feature f")
def structure(r: Roles) -> DataFrame:
    """Names of points fall into the site that they begin with and a point: any number of sites, by a join on prefixes."""
    rows = r.feature.select("uuid", text.feature_key(F.col("name")).alias("key"))
    st = rs.structure(F.col("key"), F.col("site"))
    out = rows.join(rs.sites_of(rows, r.feature), "key").withColumn("st", st)
    # canonical points drop leading zeros: put them back for comparison with the name
    point = F.concat(F.substring("st.point", 1, 1), F.lpad(F.substring("st.point", 2, 20), 6, "0"))
    return out.select("uuid", F.col("st.site").alias("site"), point.alias("point"))


@query("e12_units_drift", "SELECT DISTINCT uuid_analyte, units FROM (SELECT uuid_analyte, units FROM lab_method UNION ALL SELECT uuid, units FROM analyte) WHERE units IS NOT NULL")
def units_drift(r: Roles) -> DataFrame:
    return reg.units_drift(r.lab_method, r.analyte.select(F.col("uuid").alias("uuid_analyte"), "units"), "uuid_analyte", "units")


@query("e15_sample_counts", "SELECT 'WO ' || substr(uuid_project, 2) AS work_order, count(*) AS n_samples FROM sample WHERE CAST(substr(uuid_project, 2) AS INT) % 3 <> 0 GROUP BY 1")
def sample_counts(r: Roles) -> DataFrame:
    p = r.sample.select("uuid_project").distinct()
    n = F.substring("uuid_project", 2, 9)
    p = p.select(F.col("uuid_project").alias("uuid"), F.concat(F.lit("WO "), n).alias("name"), F.when(n.cast("int") % 3 == 0, "Report").otherwise("Work order").alias("type"))
    return event.sample_counts(r.sample, p)


def recorded(r: Roles) -> DataFrame:
    k = F.col("o_orderkey")
    return r.table("orders").select(F.concat(F.lit("h"), s("o_orderkey")).alias("hash"), F.when(k % 5 != 0, F.concat(F.lit("WO"), (k % 40).cast("string"))).alias("work_order"), F.when(k % 4 != 0, k % 6).cast("int").alias("revision"))


def event_files(r: Roles) -> DataFrame:
    k = F.col("o_orderkey")
    return r.table("orders").select(
        F.concat(F.lit("h"), s("o_orderkey")).alias("hash"), F.concat(F.lit("e"), s("o_custkey")).alias("event"), F.when(k % 9 != 0, F.concat(F.lit("WO"), (k % 30).cast("string"))).alias("home"),
        F.when(k % 3 != 0, F.concat(F.lit("R"), (k % 50).cast("string"))).otherwise("").alias("report_no"),
    )


@query(
    "e16_incoming_revisions",
    """WITH f AS (SELECT 'e' || o_custkey AS event, CASE WHEN o_orderkey % 5 <> 0 THEN 'WO' || (o_orderkey % 40) END AS wo, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 6 END AS rev FROM orders),
o AS (SELECT DISTINCT 'e' || o_custkey AS event, 'WO' || (o_orderkey % 40) AS work_order FROM orders),
a AS (SELECT event, wo AS work_order, max(rev) AS fr FROM f GROUP BY 1, 2), b AS (SELECT DISTINCT event, work_order, 9 AS rr FROM o WHERE length(event) % 2 = 0)
SELECT event, work_order, CAST(coalesce(fr, rr) AS INTEGER) AS incoming_revision FROM o LEFT JOIN a USING (event, work_order) LEFT JOIN b USING (event, work_order)""",
)
def incoming_revisions(r: Roles) -> DataFrame:
    f = event_files(r)
    orders = f.select("event", F.concat(F.lit("WO"), (F.substring("hash", 2, 20).cast("long") % 40).cast("string")).alias("work_order")).distinct()
    clean = orders.where("length(event) % 2 = 0").withColumn("revision", F.lit(9)).withColumn("home", F.lit(None).cast("string"))
    return event.incoming_revisions(orders, f, recorded(r), clean)


@query("e23_current_states", "SELECT 'h' || c_custkey AS hash, CASE WHEN o.k IS NOT NULL THEN CASE WHEN c_custkey % 2 = 0 THEN 'archived' ELSE 'ignored' END END AS state FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey % 5 <> 0) o ON o.k = c_custkey")
def current_states(r: Roles) -> DataFrame:
    k = F.col("o_custkey")
    known = r.table("orders").where(k % 5 != 0).select(k).distinct().select(F.concat(F.lit("h"), s("o_custkey")).alias("hash"), F.when(k % 2 == 0, "archived").otherwise("ignored").alias("state"), F.lit(None).cast("string").alias("reason"))
    return ingest.current_states(r.table("customer").select(F.concat(F.lit("h"), s("c_custkey")).alias("hash")), known).select("hash", "state")


@query("e32_report_numbers", "SELECT 'e' || o_custkey AS event, min('R' || (o_orderkey % 50)) AS report_no FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1")
def report_numbers(r: Roles) -> DataFrame:
    return event.report_numbers(event_files(r))


@query("e34_work_orders", "SELECT DISTINCT 'e' || o_custkey AS event, w AS work_order FROM (SELECT o_custkey, unnest([CASE WHEN o_orderkey % 9 <> 0 THEN 'WO' || (o_orderkey % 30) END, CASE WHEN o_orderkey % 5 <> 0 THEN 'WO' || (o_orderkey % 40) END]) AS w FROM orders) WHERE w IS NOT NULL")
def work_orders(r: Roles) -> DataFrame:
    return event.work_orders(event_files(r), recorded(r))


# assembly and reviews


@query("p03_home_work_order", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'WO' || o_custkey WHEN o_orderkey % 7 <> 0 THEN 'G' || o_orderkey END AS home FROM orders")
def home_work_order(r: Roles) -> DataFrame:
    k = F.col("o_orderkey")
    said = F.when(k % 3 == 0, F.concat(F.lit("WO"), s("o_custkey"), F.lit(" "))).when(k % 3 == 1, " ")
    return r.table("orders").select("o_orderkey", asm.home_work_order(said, F.when(k % 7 != 0, F.concat(F.lit("G"), s("o_orderkey")))).alias("home"))


def delivered(r: Roles) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Orders as files of customers' work orders, line items as results, and samples for every other file."""
    o = r.table("orders")
    k = F.col("o_orderkey")
    h = F.concat(F.lit("h"), F.lpad(s("o_orderkey"), 10, "0"))
    adapter = F.when(k % 2 == 0, "esdat/1.0").otherwise("als_xtab/1.0")
    files = o.select(h.alias("hash"), h.alias("filename"), adapter.alias("adapter"), F.when(k % 11 != 0, F.concat(F.lit("WO"), s("o_custkey"))).alias("work_order_guess"), (k % 3).cast("int").alias("revision_guess"))
    li = r.table("lineitem").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == k).where("l_orderkey % 13 <> 0")
    foreign = F.col("l_partkey") % 10
    wo = F.when(foreign == 0, "WOX").when(foreign == 1, "WOY").when(foreign == 2, F.concat(F.lit("WO"), s("o_custkey")))
    results = li.select(
        h.alias("source_hash"), F.concat_ws("-", s("l_linenumber"), s("l_partkey"), s("l_suppkey"), s("l_quantity")).alias("source_ref"), wo.alias("work_order"),
        F.when(foreign == 1, "NCP").alias("sample_type"), F.concat(F.lit("s"), s("l_linenumber")).alias("lab_sample_id"), F.lit(None).cast("string").alias("feature_raw"), F.lit(None).cast("string").alias("sample_datetime_raw"),
    )
    ids = F.explode(F.array(*[F.lit(f"s{i}") for i in range(1, 8)])).alias("lab_sample_id")
    samples = o.where("o_orderkey % 2 = 0").select(h.alias("source_hash"), ids, F.col("o_custkey")).select(
        "source_hash", F.col("lab_sample_id").alias("source_ref"), "lab_sample_id", F.concat(F.lit("P"), s("o_custkey"), "lab_sample_id").alias("feature_raw"),
        F.lit("07 May 2024").alias("sample_datetime_raw"), F.lit(None).cast("string").alias("sample_type"), F.lit(None).cast("string").alias("parent_sample"), F.lit("WATER").alias("matrix_raw"),
    )
    reports = o.where("o_orderkey % 17 = 0").select(h.alias("source_hash"), F.lit("WOR").alias("work_order"), F.lit("R1").alias("report_no"))
    return results, samples, reports, files


ASSEMBLED = """
f AS (SELECT o_orderkey AS k, 'h' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS hash, o_custkey, CASE WHEN o_orderkey % 17 = 0 THEN 'WOR' WHEN o_orderkey % 11 <> 0 THEN 'WO' || o_custkey END AS home, o_orderkey % 3 AS rev,
  o_orderkey IN (SELECT l_orderkey FROM lineitem) AND o_orderkey % 13 <> 0 AS has FROM orders),
g AS (SELECT *, coalesce('wo::' || home, '__orphan__::' || hash) AS event FROM f),
w AS (SELECT *, NOT has OR row_number() OVER (PARTITION BY event, has ORDER BY CASE WHEN k % 2 = 0 THEN 3 ELSE 1 END DESC, rev DESC, hash) = 1 AS kept FROM g),
own AS (SELECT w.*, l_linenumber, l_partkey, l_partkey % 10 AS x FROM w JOIN lineitem ON l_orderkey = k WHERE has AND kept),
rows AS (SELECT *, CASE WHEN x = 0 THEN 'WOX' WHEN x = 1 THEN 'WOY' WHEN x = 2 THEN 'WO' || o_custkey END AS wo FROM own),
flagged AS (SELECT *, wo IS NOT NULL AND home IS NOT NULL AND wo <> home AS alien FROM rows)
"""


@query("p01_assemble_events", f"WITH {ASSEMBLED} SELECT event, count(*) AS n_rows, count(*) FILTER (alien) AS n_review, count(*) FILTER (EXISTS (SELECT 1 FROM g s WHERE s.event = flagged.event AND s.k % 2 = 0)) AS n_named FROM flagged WHERE NOT (alien AND x = 1) GROUP BY 1")
def assemble_events(r: Roles) -> DataFrame:
    rows, _ = asm.assemble(*delivered(r))
    return rows.groupBy("event").agg(F.count("*").alias("n_rows"), F.count_if("needs_review").alias("n_review"), F.count("feature_raw").alias("n_named"))


@query("p02_group_events", f"WITH {ASSEMBLED} SELECT hash, event, CASE WHEN kept THEN 'assembled' ELSE 'ignored' END AS state, CASE WHEN NOT kept THEN 'superseded_by_better_source' END AS reason FROM w")
def group_events(r: Roles) -> DataFrame:
    _, files = asm.assemble(*delivered(r))
    return files.select("hash", "event", "state", "reason")


@query(
    "n13_flag_conflicts",
    "SELECT CASE WHEN l_partkey % 10 = 0 THEN 'other' WHEN l_linenumber > 2 OR l_suppkey % 3 = 0 THEN 'value_conflict' END AS kind, CASE WHEN l_partkey % 10 = 0 THEN 'foreign' WHEN l_linenumber > 2 THEN 'day' WHEN l_suppkey % 3 = 0 THEN 'type' END AS subkind, (l_partkey % 10 = 0)::INT + (l_linenumber > 2)::INT + (l_suppkey % 3 = 0)::INT AS n_facts, count(*) AS n FROM lineitem GROUP BY 1, 2, 3",
)
def flag_conflicts(r: Roles) -> DataFrame:
    """The first flag names the kind, the facts of all are kept."""
    first = F.col("l_partkey") % 10 == 0
    rows = r.table("lineitem").select(
        "l_linenumber", "l_suppkey", first.alias("needs_review"), F.when(first, "other").alias("review_kind"), F.when(first, "foreign").alias("review_subkind"), F.when(first, F.create_map(F.lit("order"), F.lit("x"))).alias("review_facts")
    )
    rows = asm.flag_conflict(rows, F.col("l_linenumber") > 2, "day", F.create_map(F.lit("day"), s("l_linenumber")))
    rows = asm.flag_conflict(rows, F.col("l_suppkey") % 3 == 0, "type", F.create_map(F.lit("type"), s("l_suppkey")))
    n = F.coalesce(F.when(F.col("review_facts").isNotNull(), F.size("review_facts")), F.lit(0)).alias("n_facts")
    return rows.groupBy(F.col("review_kind").alias("kind"), F.col("review_subkind").alias("subkind"), n).agg(F.count("*").alias("n"))


@query(
    "n04_skip_rows",
    "SELECT source_ref, CASE WHEN k % 2 = 0 THEN 'already_present' ELSE 'method_duplicate' END AS reason, 'h' || k AS source_hash, CASE WHEN k % 2 = 0 THEN uuid END AS existing_uuid, CASE WHEN k % 2 = 1 THEN uuid_lab END AS kept_uuid_lab, CASE WHEN k % 2 = 0 THEN '{\"existing_uuid\":\"' || uuid || '\"}' ELSE '{\"kept_uuid_lab\":\"' || uuid_lab || '\"}' END AS payload FROM (SELECT *, uuid AS source_ref FROM stored) WHERE k % 3 = 0",
)
def skip_rows(r: Roles) -> DataFrame:
    k = F.col("k")
    rows = r.stored.select(
        F.col("uuid").alias("source_ref"), F.concat(F.lit("h"), k.cast("string")).alias("source_hash"), F.when(k % 3 == 0, "skipped").otherwise("clean").alias("disposition"),
        F.when(k % 2 == 0, "already_present").otherwise("method_duplicate").alias("reason"), F.when(k % 2 == 0, F.col("uuid")).alias("e_uuid"), F.when(k % 2 == 1, F.col("uuid_lab")).alias("kept_uuid_lab"), F.lit(None).cast("string").alias("twin"),
    )
    return edits.skip_rows(rows)


@query("n03_review_rows", "SELECT organisation, name, count(*) AS n_rows, string_agg(DISTINCT uuid, ',' ORDER BY uuid) AS source_ref, coalesce(string_agg(DISTINCT method, ',' ORDER BY method), '') AS candidates FROM lab_method GROUP BY 1, 2")
def review_rows(r: Roles) -> DataFrame:
    rows = r.lab_method.select("organisation", "name", F.col("uuid").alias("source_ref"), F.when(F.col("method").isNotNull(), F.array("method")).alias("candidates"))
    return rv.review_rows(rows, ["organisation", "name"]).withColumn("candidates", F.array_join("candidates", ","))


@query("n08_unknown_units_open", "SELECT uuid, units FROM lab_method WHERE units NOT IN ('mg/L', 'g/L')")
def unknown_units_open(r: Roles) -> DataFrame:
    asked = r.lab_method.where("units in ('mg/L', 'g/L')").select(F.to_json(F.struct("units")).alias("payload"), F.lit("open").alias("status")).distinct()
    return rv.already_open(r.lab_method.where("units is not null").select("uuid", "units"), asked, "$.units", "units")


@query("p40_reported_as", "SELECT p_partkey, p_type AS reported_as, CASE WHEN p_partkey % 3 = 0 THEN 'filled' WHEN p_partkey % 3 = 1 THEN 'kept' ELSE 'conflict' END AS status FROM part WHERE regexp_full_match(p_type, '\\w+') AND p_partkey % 3 <> 2 UNION ALL SELECT p_partkey, '?', 'conflict' FROM part WHERE regexp_full_match(p_type, '\\w+') AND p_partkey % 3 = 2")
def reported_as(r: Roles) -> DataFrame:
    k = F.col("p_partkey")
    m = r.table("part").select(s("p_partkey").alias("uuid"), F.concat("p_name", F.lit(" as "), "p_type").alias("name"), F.when(k % 3 == 1, F.col("p_type")).when(k % 3 == 2, "?").alias("reported_as"))
    return edits.reported_as(m).select(F.col("uuid").cast("long").alias("p_partkey"), "reported_as", "status")


@query("p09_reconcile_event")
def reconcile_event(r: Roles) -> DataFrame:
    """Re-delivered analyses as raw text, through all stages: rows by outcome. Tests hold it against rows worked out by hand."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("Australia/Sydney"), "datetime")
    value = F.when(F.col("quantified") == F.lit(False), F.concat(F.lit("<"), s("rl_low"))).otherwise(F.coalesce(s("value"), "value_chr"))
    none = F.lit(None).cast("string")
    rows = r.incoming_named.select(
        "row", F.concat(F.lit("e"), "uuid_sample").alias("event"), F.lit(False).alias("orphan"), F.lit("h").alias("source_hash"), "source_ref", none.alias("sample_type"), F.lit(False).alias("needs_review"),
        none.alias("review_kind"), none.alias("review_subkind"), "feature_raw", "analyte_raw", F.col("organisation").alias("org"), F.col("method").alias("method_raw"), F.col("units").alias("units_raw"),
        value.alias("value_raw"), F.coalesce(F.date_format(local, "dd MMM yyyy HH:mm"), F.date_format("date", "dd MMM yyyy")).alias("sample_datetime_raw"), "revision",
    )
    known = event.Registry(r.feature, r.feature_alias, r.analyte, r.lab_method, r.analysis, r.stored)
    return event.outcome_counts(event.reconcile_events(rows, known))
