"""Irregular grids as long cells (file, sheet, r, c, v): sections, carried headers and unpivoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, values

# Labels of crosstab rows.
SECTION = r"Matrix:"
LABELS = {
    "workgroup": r"^Workgroup:",
    "sample_type": r"^Sample Type:",
    "sample_number": r"^ALS Sample num",
    "sample_date": r"^Sample Date:",
    "feature": r"^Client sample ID \((1st|Primary)\)",
}


def find_cells(cells: DataFrame, pattern: str) -> DataFrame:
    """Cells that match a pattern in any case, in column-major order."""
    return cells.where(F.regexp_replace(F.trim("v"), r"\s+", " ").rlike(f"(?i){pattern}")).orderBy("file", "sheet", "c", "r")


def first_cell(cells: DataFrame, pattern: str) -> DataFrame:
    """The first matching cell of each sheet by column, then row."""
    hit = cells.where(F.col("v").rlike(f"(?i){pattern}"))
    g = hit.groupBy("file", "sheet").agg(F.min(F.struct("c", "r", "v")).alias("_m"))
    return g.select("file", "sheet", F.col("_m.r").alias("r"), F.col("_m.c").alias("c"), F.col("_m.v").alias("v"))


def beside(cells: DataFrame, pattern: str, direction: str = "right") -> DataFrame:
    """Non-empty cells right of, left of, above or below the first cell that matches, in order: values."""
    key = first_cell(cells, pattern).select("file", "sheet", F.col("r").alias("kr"), F.col("c").alias("kc"))
    both = cells.join(key, ["file", "sheet"])
    where, order = {
        "right": ("r = kr and c > kc", F.col("c")),
        "left": ("r = kr and c < kc", -F.col("c")),
        "down": ("c = kc and r > kr", F.col("r")),
        "up": ("c = kc and r < kr", -F.col("r")),
    }[direction]
    rows = both.where(where).where("trim(v) <> ''")
    g = rows.groupBy("file", "sheet").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "v"))).alias("_v"))
    return g.select("file", "sheet", F.transform("_v", lambda x: x["v"]).alias("values"))


def carried(value: Column, keys: list[str], order: str) -> Column:
    """The last non-empty value at or before each place (merged header cells)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(F.when(F.trim(value) != "", value), ignorenulls=True).over(w)


def sections(rows: DataFrame, keys: list[str], marker: Column, supported: Column) -> DataFrame:
    """Adds section (0 before the first marker) and in_section: rows after a supported marker."""
    w = Window.partitionBy(*keys).orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("section", F.sum(marker.cast("int")).over(w))
    return out.withColumn("in_section", F.coalesce(F.last(F.when(marker, supported), ignorenulls=True).over(w), F.lit(False)))


def blocks(ends: Column, keys: list[str], order: str) -> Column:
    """Number of the block of each row, where a block ends with its marker row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(ends.cast("int")).over(w), F.lit(0)) + 1


def occurrence(keys: list[str], order: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order))


def unpivot_crosstab(cells: DataFrame, dialect: str = "^Matrix:") -> DataFrame:
    """Results of stacked crosstab sections.

    A section starts at a matrix marker; labelled rows give the sample columns their
    number, type, date and feature; the row with `CAS Number` fixes the CAS, unit and limit
    columns; after it a row without values in sample columns is the method of the rows
    below. Returns file, sheet, section, source_ref, analyte_raw, method_raw, cas_number,
    units_raw, limit_raw, lab_sample_id, feature_raw, sample_type, sample_date_raw, value_raw.
    """
    keys = ["file", "sheet"]
    v = F.col("v")
    c = cells.where("trim(coalesce(v, '')) <> ''").withColumn("v", F.trim("v"))
    # cells are moved once, by sheet, and never written; every step below is a window within a sheet
    c = c.withColumn("_first", ~F.lag("r").over(Window.partitionBy(*keys).orderBy("r", "c", "v")).eqNullSafe(F.col("r")))
    # what a row is stands in its first cell, or in the cell of the CAS column
    marker, kind = v.rlike(f"{SECTION}\\s*"), F.lit(None).cast("string")
    for name, pattern in LABELS.items():
        kind = F.when(v.rlike(f"(?i){pattern}"), name).otherwise(kind)
    c = c.withColumn("_kind", F.when(F.col("_first"), F.when(marker, "marker").otherwise(kind)))
    c = c.withColumn("_dialect", F.when(F.col("_kind") == "marker", v.rlike(dialect)))
    row = Window.partitionBy(*keys, "r")
    c = c.withColumns({
        "kind": F.first("_kind", ignorenulls=True).over(row), "first_c": F.min("c").over(row),
        "cas_c": F.max(F.when(v.rlike("(?i)^CAS Number$"), F.col("c"))).over(row),
    })
    upto = Window.partitionBy(*keys).orderBy("r").rangeBetween(Window.unboundedPreceding, 0)  # all cells of a row get the same
    c = c.withColumns({"section": F.count(F.when(F.col("_kind") == "marker", 1)).over(upto), "in_section": F.last("_dialect", ignorenulls=True).over(upto)})
    kind = F.when(F.col("kind") == "marker", "marker").when(F.col("cas_c").isNotNull(), "columns").otherwise(F.coalesce("kind", F.lit("body")))
    c = c.where("in_section").select(*keys, "section", "r", "c", "v", "first_c", "cas_c", kind.alias("kind"))
    where = [*keys, "section"]

    # what the labelled rows say of each column, then what the header says of the section
    column, whole = Window.partitionBy(*where, "c"), Window.partitionBy(*where)
    said = lambda k: F.min(F.when((F.col("kind") == k) & (F.col("c") > F.col("first_c")), v)).over(column)
    header = F.col("kind") == "columns"
    at = lambda x, when=header: F.min(F.when(when, F.col(x))).over(whole)
    c = c.withColumns({f"col_{k}": said(k) for k in ("sample_number", "sample_type", "sample_date", "feature")})
    c = c.withColumns({
        "header_r": at("r"), "name_c": at("first_c"), "_cas": at("cas_c"), "unit_c": at("c", header & v.rlike("(?i)^Unit")),
        "limit_c": at("c", header & v.rlike("(?i)^(Limit of reporting|LOR)")),
    })
    body = c.where("kind = 'body' and r > header_r").drop("kind", "first_c", "cas_c", "header_r")
    part = lambda name: F.max(F.when(F.col("c") == F.col(name), v))
    line = Window.partitionBy(*where, "r")
    body = body.withColumns({
        "analyte_raw": part("name_c").over(line), "cas_number": part("_cas").over(line), "units_raw": part("unit_c").over(line),
        "limit_raw": part("limit_c").over(line), "n_values": F.count("col_sample_number").over(line),
    }).where("analyte_raw is not null")
    # cells of lines, and of each heading the one that names it; the heading's text is carried down
    body = body.where("col_sample_number is not null or (n_values = 0 and c = name_c)")
    body = body.withColumn("method_raw", carried(F.when(F.col("n_values") == 0, F.col("analyte_raw")), where, "r"))
    out = body.where("col_sample_number is not null and n_values > 0").withColumnRenamed("v", "value_raw")
    return out.select(
        *where, F.concat(F.lit("r"), F.col("r").cast("string"), F.lit("c"), F.col("c").cast("string")).alias("source_ref"),
        "analyte_raw", "method_raw", "cas_number", "units_raw", "limit_raw", F.col("col_sample_number").alias("lab_sample_id"),
        F.col("col_feature").alias("feature_raw"), text.sample_type(F.col("col_sample_type")).alias("sample_type"),
        F.col("col_sample_date").alias("sample_date_raw"), "value_raw",
    )


def column_remarks(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Comments of each column in row order, joined by `; `, and the first stage and appearance with their cells."""
    o = text.observation(F.col("v"))
    rows = cells.where("trim(coalesce(v, '')) <> ''").withColumn("o", o)
    ref = F.concat(F.lit("r"), F.col("r").cast("string"), F.lit("c"), F.col("c").cast("string"))
    first = lambda part: F.min(F.when(F.col(f"o.{part}").isNotNull(), F.struct("r", F.col(f"o.{part}").alias("v"), ref.alias("ref"))))
    g = rows.groupBy(*keys, "c").agg(
        F.array_sort(F.collect_list(F.struct("r", "v"))).alias("_all"), first("stage").alias("_s"), first("appearance").alias("_a")
    )
    return g.select(
        *keys, "c", F.array_join(F.transform("_all", lambda x: x["v"]), "; ").alias("comments"),
        F.col("_s.v").alias("stage"), F.col("_s.ref").alias("stage_ref"), F.col("_a.v").alias("appearance"), F.col("_a.ref").alias("appearance_ref"),
    )


def classify_line(analyte: Column, unit: Column, n_values: Column, allowed: Column) -> Column:
    """What a labelled row of a workbook's water sheet is, by the first rule that holds."""
    return (
        F.when(text.is_comment_label(analyte), "comment")
        .when(analyte.rlike(r"(?i)^(site|sample|sampled by|time|date)\b"), "site_metadata_label")
        .when(analyte.rlike(r"(?i)^template\b"), "stale_template_label")
        .when(analyte.rlike(r"(?i)aroclor") & (unit == "%"), "aroclor_surrogate_percent")
        .when(n_values == 0, "heading")
        .when(~values.is_true(allowed), "transcription_label")
        .otherwise("result")
    )


def dust_results(results: DataFrame, observations: DataFrame) -> DataFrame:
    """Dust results with their observations by gauge and block; the exposure day holds, else the month's.

    Adds conflict where both are known and differ.
    """
    o = observations.select("gauge", "block", F.col("date").alias("exposure_date"), "comments")
    out = results.join(o, ["gauge", "block"], "left")
    return out.withColumn("sample_date", F.coalesce("exposure_date", "month_date")).withColumn(
        "conflict",
        F.when(
            F.col("exposure_date").isNotNull() & F.col("month_date").isNotNull() & (F.date_trunc("month", "exposure_date") != F.date_trunc("month", "month_date")),
            "dust_exposure_date_conflict",
        ),
    )
