"""Sheets of field workbooks, from long cells: the water sheet, dust results and dust observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, text, values
from . import grids

KEYS = ["file", "sheet"]


def sheet_kind(cells: DataFrame) -> DataFrame:
    """What each sheet is, by its markers near the top: front, dust, water or other."""
    top = cells.withColumn("v", F.trim("v"))
    has = lambda pattern, rows: F.bool_or((F.col("r") <= rows) & F.col("v").rlike(f"(?i){pattern}"))
    kind = (
        F.when(has("^REPORT NO", 15), "front")
        .when(has("^GAUGE NO", 20) & has("^INSOLUBLE SOLID", 20), "dust")
        .when(has("^Units$", 15), "water")
        .otherwise("other")
    )
    return top.groupBy(*KEYS).agg(kind.alias("kind"))


def date_text(v: Column) -> Column:
    """A date cell as d/m/Y text: Excel serials are converted, others stay."""
    serial = v.try_cast("double")
    return F.when(serial.isNotNull(), F.date_format(dates.excel_date(serial), "dd/MM/yyyy")).otherwise(v)


def water_sheet(cells: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows of water sheets: a cell or line each, with kind and, for results, the sample's point and date.

    The `Site Name` cell fixes the header row and the label column; units stand beside it,
    samples in the header's later cells. Dates come from the nearest `date` row above, else
    below, and carry over empty cells. Lines are classified in a fixed order; in result
    lines `--` is `not_analysed` and unreadable values keep their parse struct. allowed:
    analytes (key) that field staff measure; other labels are transcriptions. Sheets without
    a header give no_site_row. Returns file, sheet, source_ref, kind, analyte_raw, units_raw,
    feature_raw, sample_date_raw, value_raw, parsed.
    """
    v, r, c = F.col("v"), F.col("r"), F.col("c")
    x = cells.where("trim(coalesce(v, '')) <> ''").withColumn("v", F.trim("v"))
    # cells are moved once, by sheet, and never written; lines, with their cells, once more, to the allowed labels
    sheet = Window.partitionBy(*KEYS)
    x = x.withColumn("_n", F.row_number().over(sheet.orderBy("c", "r")))
    x = x.withColumn("_head", F.min(F.when(v.rlike(r"(?i)^Site Name\b"), F.struct("c", "r"))).over(sheet))
    x = x.withColumns({"r0": F.col("_head.r"), "c0": F.col("_head.c")}).drop("_head")
    mark = lambda when: F.when((c == F.col("c0")) & when & v.rlike(r"(?i)\bdate\b"), r)
    x = x.withColumn("date_r", F.coalesce(F.max(mark(r < F.col("r0"))).over(sheet), F.min(mark(r > F.col("r0"))).over(sheet)))
    column, upto = Window.partitionBy(*KEYS, "c"), sheet.orderBy("c").rangeBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({"feature_raw": F.max(F.when((r == F.col("r0")) & (c > F.col("c0") + 1), v)).over(column), "_d": F.max(F.when(r == F.col("date_r"), v)).over(column)})
    x = x.withColumn("sample_date_raw", date_text(F.last(F.when(F.col("feature_raw").isNotNull(), F.col("_d")), ignorenulls=True).over(upto)))

    none = F.col("r0").isNull()
    x = x.where((none & (F.col("_n") == 1)) | ((r > F.col("r0")) & (F.col("date_r").isNull() | (r != F.col("date_r")))))
    lines = x.groupBy(*KEYS, "r").agg(
        F.max(F.when(c == F.col("c0"), v)).alias("analyte_raw"),
        F.max(F.when(c == F.col("c0") + 1, v)).alias("units_cell"),
        F.collect_list(F.when(F.col("feature_raw").isNotNull(), F.struct("c", v.alias("value_raw"), "feature_raw", "sample_date_raw"))).alias("_cells"),
        F.bool_and(none).alias("_none"),
    ).where("analyte_raw is not null or _none")
    ok = allowed.select(F.col("key").alias("_key")).distinct().withColumn("_ok", F.lit(True))
    lines = lines.join(ok, text.method_key(F.col("analyte_raw")) == F.col("_key"), "left").drop("_key")
    kind = grids.classify_line(F.col("analyte_raw"), F.col("units_cell"), F.size("_cells"), F.col("_ok"))
    lines = lines.withColumn("kind", F.when(F.col("_none"), "no_site_row").otherwise(kind))
    lines = lines.withColumn("units_raw", text.repair_units(F.col("analyte_raw"), F.col("units_cell")))
    # of a result line its cells, of another the line itself
    out = lines.select(*KEYS, "r", "kind", "analyte_raw", "units_raw", F.explode_outer(F.when(F.col("kind") == "result", F.col("_cells"))).alias("x"))
    ref = F.when(F.col("x").isNotNull(), F.concat(F.lit("r"), r.cast("string"), F.lit("c"), F.col("x.c").cast("string"))).when(F.col("kind") != "no_site_row", F.concat(F.lit("r"), r.cast("string")))
    return out.select(
        *KEYS, ref.alias("source_ref"), F.when(F.col("x.value_raw").rlike("^-+$"), "not_analysed").otherwise(F.col("kind")).alias("kind"), "analyte_raw", "units_raw", F.col("x.feature_raw").alias("feature_raw"),
        F.col("x.sample_date_raw").alias("sample_date_raw"), F.col("x.value_raw").alias("value_raw"), F.when(F.col("x").isNotNull(), values.parse_value(F.col("x.value_raw"))).alias("parsed"),
    )


def dust_sheet(cells: DataFrame) -> DataFrame:
    """Dust results: each gauge's value of each analyte column, with its block.

    Analytes stand in the row of `GAUGE NO`; a value is read below its heading, or one
    column further where that is empty; blocks end with `Exposure Days` rows.
    """
    c = cells.where("trim(coalesce(v, '')) <> ''").withColumn("v", F.trim("v"))
    head = grids.first_cell(c, r"^GAUGE NO").select(*KEYS, F.col("r").alias("r0"), F.col("c").alias("c0"))
    c = c.join(head, KEYS)
    analytes = c.where("r = r0 and c > c0").select(*KEYS, F.col("c").alias("ac"), F.col("v").alias("analyte_raw"))
    first = c.where("r > r0 and c = c0").select(*KEYS, "r", F.col("v").alias("gauge"))
    first = first.withColumn("block", grids.blocks(F.col("gauge").rlike("(?i)^Exposure Days"), KEYS, "r")).where(~F.col("gauge").rlike("(?i)^Exposure Days"))
    value = c.select(*KEYS, "r", "c", F.col("v").alias("value_raw"))
    wide = first.join(analytes, KEYS)
    near = wide.join(value, KEYS + ["r"]).where("c = ac or c = ac + 1")
    own = analytes.select(*KEYS, F.col("ac").alias("c")).withColumn("_heading", F.lit(True))
    near = near.join(own, [*KEYS, "c"], "left").where("c = ac or _heading is null")  # the next heading's values are its own
    g = near.groupBy(*KEYS, "r", "gauge", "block", "analyte_raw").agg(F.min(F.struct("c", "value_raw")).alias("x"))
    return g.select(*KEYS, "gauge", "block", "analyte_raw", F.concat(F.lit("r"), F.col("r").cast("string"), F.lit("c"), F.col("x.c").cast("string")).alias("source_ref"), F.col("x.value_raw").alias("value_raw"))


def dust_observations(cells: DataFrame) -> DataFrame:
    """Observations of gauges: the block is the gauge's occurrence; date and remarks stand right of it."""
    c = cells.where("trim(coalesce(v, '')) <> ''").withColumn("v", F.trim("v"))
    head = grids.first_cell(c, r"^GAUGE").select(*KEYS, F.col("r").alias("r0"), F.col("c").alias("c0"))
    c = c.join(head, KEYS).where("r > r0 and c >= c0")
    g = c.groupBy(*KEYS, "r").agg(
        F.max(F.when(F.col("c") == F.col("c0"), F.col("v"))).alias("gauge"),
        F.max(F.when(F.col("c") == F.col("c0") + 1, F.col("v"))).alias("date_raw"),
        F.array_sort(F.collect_list(F.when(F.col("c") > F.col("c0") + 1, F.struct("c", "v")))).alias("_said"),
    ).where("gauge is not null")
    g = g.withColumn("block", grids.occurrence([*KEYS, "gauge"], "r"))
    date = F.to_date(dates.parse_local(date_text(F.col("date_raw")), "crosstab"))
    return g.select(*KEYS, "gauge", "block", date.alias("date"), F.array_join(F.transform("_said", lambda x: x["v"]), "; ").alias("comments"))


# Keys of a front page.
FRONT_KEYS = {"report_no": "^REPORT NO:$", "sampled_by": "^SAMPLED BY:$", "sample_date": "^SAMPLE DATE:$"}


def front_page(cells: DataFrame) -> DataFrame:
    """What front pages say right of their keys: file, report_no, sampled_by, sample_date.

    A key that stands in no cell, or in several, says nothing. Of samplers the first counts.
    """
    c = cells.where("trim(coalesce(v, '')) <> ''").withColumn("v", text.squish(F.col("v")))
    key = F.lit(None).cast("string")
    for name, pattern in FRONT_KEYS.items():
        key = F.when(F.col("v").rlike(f"(?i){pattern}"), name).otherwise(key)
    marks = c.withColumn("key", key).where("key is not null").groupBy("file", "key").agg(F.count("*").alias("n"), F.min("sheet").alias("sheet"), F.min("r").alias("r"), F.min("c").alias("kc"))
    right = c.join(marks.where("n = 1").drop("n"), ["file", "sheet", "r"]).where("c > kc")
    said = right.groupBy("file", "key").agg(F.min(F.struct("c", "v"))["v"].alias("v"))
    one = said.groupBy("file").agg(*[F.max(F.when(F.col("key") == k, F.col("v"))).alias(k) for k in FRONT_KEYS])
    out = cells.select("file").distinct().join(one, "file", "left")
    return out.withColumn("sampled_by", F.trim(F.regexp_replace("sampled_by", "&.*$", "")))
