"""Queries of measurement views, statistics and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import measurement as m
from ..operators import registry as reg
from ..operators import statistics as st
from .registry import query
from .roles import Roles

#: Spine rows with their rank, as SQL.
RANKED = """
ranked AS (
  SELECT a.uuid AS a_uuid, s.uuid AS s_uuid, f.uuid AS f_uuid, f.name AS f_name, f.site, f.campaign, lm.uuid_analyte, lm.method, lm.units AS lm_units, a.value, a.value_chr, a.quantified, s.datetime,
    CAST(s.datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE) AS date,
    COALESCE(lm.method IN ('field', 'EN67 - Client Supplied Data'), FALSE) AS is_field,
    row_number() OVER (PARTITION BY f.uuid, CAST(s.datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE), COALESCE(lm.uuid_analyte, 'analysis:' || a.uuid)
      ORDER BY COALESCE(lm.preference, 500), COALESCE(lm.method IN ('field', 'EN67 - Client Supplied Data'), FALSE) DESC, COALESCE(lm.organisation = 'ALS', FALSE) DESC, s.uuid, a.uuid) AS preference_rank
  FROM analysis a JOIN sample s ON a.uuid_sample = s.uuid JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid JOIN feature f ON fa.uuid_feature = f.uuid JOIN lab_method lm ON a.uuid_lab = lm.uuid)
"""


def ranked(r: Roles) -> DataFrame:
    return m.with_preference_rank(m.spine(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method))


@query("f01_preference_rank", f"WITH {RANKED} SELECT a_uuid, CAST(preference_rank AS INTEGER) AS preference_rank, is_field, CAST(date AS VARCHAR) AS day FROM ranked")
def preference_rank(r: Roles) -> DataFrame:
    return ranked(r).select("a_uuid", "preference_rank", "is_field", F.col("date").cast("string").alias("day"))


@query("f04_rank_by_runs", f"WITH {RANKED} SELECT a_uuid, CAST(preference_rank AS INTEGER) AS preference_rank FROM ranked")
def rank_by_runs(r: Roles) -> DataFrame:
    return m.rank_by_runs(m.spine(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method))


@query(
    "f02_v_measurement",
    f"""WITH {RANKED} SELECT a_uuid, f_name AS point, an.name AS analyte, CAST(date AS VARCHAR) AS day, value, value_chr, quantified, CAST(preference_rank AS INTEGER) AS preference_rank
FROM ranked JOIN analyte an ON uuid_analyte = an.uuid""",
)
def v_measurement(r: Roles) -> DataFrame:
    v = m.measurement(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method, r.analyte)
    return v.select(
        "a_uuid", F.col("f_name").alias("point"), F.col("an_name").alias("analyte"), F.col("date").cast("string").alias("day"),
        F.col("a_value").alias("value"), F.col("a_value_chr").alias("value_chr"), F.col("a_quantified").alias("quantified"), "preference_rank",
    )


def variant(name: str, literal: str):
    @query(
        name,
        f"""WITH {RANKED} SELECT a_uuid, k.name AS point, CAST(preference_rank AS INTEGER) AS preference_rank
FROM ranked JOIN mask k ON f_uuid = k.uuid_feature WHERE upper(k.variant) = '{literal}'""",
    )
    def v(r: Roles) -> DataFrame:
        rows = m.measurement_variant(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method, r.mask, literal)
        return rows.select("a_uuid", F.col("k_name").alias("point"), "preference_rank")

    return v


v_epa = variant("f03_v_measurement_epa", "EPA")
v_long = variant("f03_v_measurement_long", "LONG")


def canonical(r: Roles) -> DataFrame:
    v = m.measurement(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method, r.analyte)
    return v.where("preference_rank = 1").where(F.col("date").between(F.lit("1996-01-01").cast("date"), F.lit("2000-12-31").cast("date"))).select(
        F.col("f_site").alias("site"), F.col("an_name").alias("pollutant"), F.col("s_uuid").alias("sample"), F.col("a_value").alias("value"),
        (~F.coalesce("a_quantified", F.lit(True))).alias("is_nd"),
    )


CANONICAL = f"""{RANKED},
rows AS (SELECT site, an.name AS pollutant, s_uuid AS sample, NOT coalesce(quantified, TRUE) AS is_nd, {{value}} AS value
  FROM ranked JOIN analyte an ON uuid_analyte = an.uuid WHERE preference_rank = 1 AND date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31')"""

STATS = """SELECT site, pollutant, count(DISTINCT sample) AS n_samples, count(*) AS n_rows, count(*) FILTER (is_nd) AS n_nd, min(value) AS lowest, round(avg(value), 6) AS mean, max(value) AS highest,
  bool_and(is_nd) FILTER (value = lo) AS lowest_nd, bool_and(is_nd) FILTER (value = hi) AS highest_nd, bool_and(is_nd) AS mean_nd
FROM (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM rows WINDOW w AS (PARTITION BY site, pollutant)) GROUP BY site, pollutant"""


def statistics_query(name: str, mode: str, value: str):
    @query(name, f"WITH {CANONICAL.format(value=value)} {STATS}")
    def q(r: Roles) -> DataFrame:
        out = st.compliance(canonical(r), ["site", "pollutant"], mode=mode)
        return out.withColumn("mean", F.round("mean", 6))

    return q


compliance = statistics_query("e02_compliance_statistics", "as_stored", "value")
compliance_half = statistics_query("e03_compliance_half", "half", "CASE WHEN NOT coalesce(quantified, TRUE) THEN value / 2 ELSE value END")
compliance_drop = statistics_query("e03_compliance_drop", "drop", "CASE WHEN coalesce(quantified, TRUE) THEN value END")


@query(
    "e01_value_ranges",
    "SELECT m.uuid_analyte, count(*) AS n, min(a.value) AS low, max(a.value) AS high FROM analysis a JOIN lab_method m ON a.uuid_lab = m.uuid WHERE a.value > 0 AND m.uuid_analyte IS NOT NULL GROUP BY 1",
)
def value_ranges(r: Roles) -> DataFrame:
    return st.value_ranges(r.analysis, r.lab_method)


@query(
    "d30_report_base_rows",
    f"""WITH {RANKED}
SELECT a_uuid, k.name AS point, am.name AS pollutant, coalesce(am.units, an.units) AS units, value * coalesce(am.conversion_constant, 1.0) AS reported
FROM ranked JOIN analyte an ON uuid_analyte = an.uuid JOIN mask k ON f_uuid = k.uuid_feature AND upper(k.variant) = 'EPA' JOIN analyte_mask am ON am.uuid_analyte = an.uuid AND am.name IS NOT NULL
WHERE preference_rank = 1""",
)
def base_rows(r: Roles) -> DataFrame:
    rows = m.measurement_variant(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method, r.mask, "EPA").where("preference_rank = 1")
    an = r.analyte.select(F.col("uuid").alias("an"), F.col("units").alias("an_units"))
    am = r.analyte_mask.where("name is not null").select(F.col("uuid_analyte").alias("am"), F.col("name").alias("pollutant"), F.col("units").alias("am_units"), F.col("conversion_constant").alias("cc"))
    out = rows.join(an, F.col("m_uuid_analyte") == F.col("an")).join(am, F.col("an") == F.col("am"))
    return out.select("a_uuid", F.col("k_name").alias("point"), "pollutant", F.coalesce("am_units", "an_units").alias("units"), (F.col("a_value") * F.coalesce("cc", F.lit(1.0))).alias("reported"))


@query(
    "d27_report_funnel",
    """
WITH base AS (SELECT a.uuid, f.site, CAST(s.datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE) AS day, f.uuid AS fid, m.uuid_analyte
  FROM analysis a JOIN sample s ON a.uuid_sample = s.uuid JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid JOIN feature f ON fa.uuid_feature = f.uuid JOIN lab_method m ON a.uuid_lab = m.uuid),
x AS (SELECT *, site IN (SELECT site FROM site WHERE campaign = 'ASIA') AS c1, coalesce(day BETWEEN DATE '1996-01-01' AND DATE '2000-12-31', FALSE) AS c2,
  fid IN (SELECT uuid_feature FROM mask) AS c3, coalesce(uuid_analyte IN (SELECT uuid_analyte FROM analyte_mask WHERE name IS NOT NULL), FALSE) AS c4 FROM base)
SELECT count(*) AS base, count(*) FILTER (c1) AS in_site, count(*) FILTER (c1 AND c2) AS in_window, count(*) FILTER (c1 AND c2 AND c3) AS feature_masked, count(*) FILTER (c1 AND c2 AND c3 AND c4) AS analyte_masked FROM x
""",
)
def report_funnel(r: Roles) -> DataFrame:
    rows = m.spine(r.analysis, r.sample, r.feature_alias, r.feature, r.lab_method)
    fm = r.mask.select(F.col("uuid_feature").alias("f_uuid")).distinct().withColumn("fm", F.lit(True))
    am = r.analyte_mask.where("name is not null").select(F.col("uuid_analyte").alias("m_uuid_analyte")).distinct().withColumn("am", F.lit(True))
    rows = rows.join(fm, "f_uuid", "left").join(am, "m_uuid_analyte", "left")
    day = dates.civil_date(F.col("s_datetime"))
    steps = {
        "base": F.lit(True), "in_site": F.col("f_campaign") == "ASIA",
        "in_window": day.between(F.lit("1996-01-01").cast("date"), F.lit("2000-12-31").cast("date")),
        "feature_masked": F.col("fm"), "analyte_masked": F.col("am"),
    }
    return st.funnel(rows, steps)


@query(
    "d28_dropped_features",
    """SELECT fa.uuid_feature, count(*) AS n_rows, count(DISTINCT s.uuid) AS n_samples FROM analysis a JOIN sample s ON a.uuid_sample = s.uuid JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid
WHERE fa.uuid_feature IS NOT NULL AND NOT EXISTS (SELECT 1 FROM mask k WHERE k.uuid_feature = fa.uuid_feature) GROUP BY 1""",
)
def dropped_features(r: Roles) -> DataFrame:
    s = r.sample.select(F.col("uuid").alias("s"), "uuid_feature_alias")
    fa = r.feature_alias.where("uuid_feature is not null").select(F.col("uuid").alias("fa"), "uuid_feature")
    rows = r.analysis.join(s, F.col("uuid_sample") == F.col("s")).join(fa, F.col("uuid_feature_alias") == F.col("fa"))
    return st.missing_masks(rows, "uuid_feature", "s", r.mask, "uuid_feature")


@query(
    "d29_dropped_analytes",
    """SELECT an.uuid, max(CASE WHEN am.uuid_analyte IS NOT NULL THEN 1 ELSE 0 END) = 1 AS has_mask FROM analyte an LEFT JOIN analyte_mask am ON an.uuid = am.uuid_analyte WHERE am.name IS NULL GROUP BY 1""",
)
def dropped_analytes(r: Roles) -> DataFrame:
    am = r.analyte_mask.select("uuid_analyte", F.col("name").alias("mask_name"))
    out = r.analyte.join(am, F.col("uuid") == F.col("uuid_analyte"), "left").where("mask_name is null")
    return out.groupBy("uuid").agg(F.bool_or(F.col("uuid_analyte").isNotNull()).alias("has_mask"))


@query(
    "e04_unit_mismatch",
    """SELECT DISTINCT am.name AS pollutant, an.name AS analyte FROM analyte an JOIN analyte_mask am ON an.uuid = am.uuid_analyte
WHERE am.units IS DISTINCT FROM an.units AND coalesce(am.conversion_constant, 1) = 1""",
)
def unit_mismatch(r: Roles) -> DataFrame:
    am = r.analyte_mask.select("uuid_analyte", F.col("name").alias("pollutant"), F.col("units").alias("units_mask"), F.coalesce("conversion_constant", F.lit(1.0)).alias("constant"))
    rows = r.analyte.select("uuid", F.col("name").alias("analyte"), F.col("units").alias("units_analyte")).join(am, F.col("uuid") == F.col("uuid_analyte"))
    return st.mismatched_units(rows)


@query("e05_repeats", f"WITH {RANKED} SELECT s_uuid, uuid_analyte, count(*) AS n FROM ranked WHERE uuid_analyte IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def repeats(r: Roles) -> DataFrame:
    rows = ranked(r).where("m_uuid_analyte is not null").select("s_uuid", F.col("m_uuid_analyte").alias("uuid_analyte"))
    return st.repeats(rows, ["s_uuid", "uuid_analyte"])


@query(
    "e07_shortfalls",
    f"""WITH {CANONICAL.format(value='value')}, s AS ({STATS}),
req AS (SELECT site, name AS pollutant, max(required) AS required FROM (SELECT site, name, 40 + k * 10 AS required FROM site, analyte UNION ALL SELECT site, name, 100 FROM site, analyte WHERE name = 'SMALL') GROUP BY 1, 2)
SELECT site, pollutant, required - n_samples AS shortfall FROM s JOIN req USING (site, pollutant) WHERE required > n_samples ORDER BY shortfall DESC, site, pollutant LIMIT 6""",
)
def shortfalls(r: Roles) -> DataFrame:
    """A top-6 report; the requirement grid is the product of two registry dimensions (25 sites, some analytes)."""
    grid = r.site.select("site", "k").join(r.analyte.select(F.col("name").alias("pollutant")), F.lit(True))
    required = grid.select("site", "pollutant", (F.lit(40) + F.col("k") * 10).cast("long").alias("required")).unionByName(
        grid.where("pollutant = 'SMALL'").select("site", "pollutant", F.lit(100).cast("long").alias("required"))
    )
    stats = st.compliance(canonical(r), ["site", "pollutant"])
    return st.shortfalls(stats, required, ["site", "pollutant"]).select("site", "pollutant", "shortfall")


@query(
    "e08_feature_dates",
    """SELECT uuid_feature, CAST(min(day) AS VARCHAR) AS date_start, CAST(max(day) AS VARCHAR) AS date_end FROM (
  SELECT uuid_feature, CAST(datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE) AS day FROM sample s JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid WHERE uuid_feature IS NOT NULL) GROUP BY 1""",
)
def feature_dates(r: Roles) -> DataFrame:
    d = m.feature_dates(r.sample, r.feature_alias)
    return d.select("uuid_feature", F.col("date_start").cast("string").alias("date_start"), F.col("date_end").cast("string").alias("date_end"))


@query("e09_pending_features", "SELECT fa.uuid, fa.alias_key, count(s.uuid) AS n_samples FROM feature_alias fa LEFT JOIN sample s ON s.uuid_feature_alias = fa.uuid WHERE fa.uuid_feature IS NULL GROUP BY 1, 2")
def pending_features(r: Roles) -> DataFrame:
    return reg.pending_features(r.feature_alias, r.sample)


@query("e10_pending_methods", "SELECT m.uuid, m.name, m.organisation, count(a.uuid) AS n_analyses FROM lab_method m LEFT JOIN analysis a ON a.uuid_lab = m.uuid WHERE m.uuid_analyte IS NULL GROUP BY ALL")
def pending_methods(r: Roles) -> DataFrame:
    return reg.pending_methods(r.lab_method, r.analysis)


@query(
    "d32_alias_usage",
    """WITH u AS (SELECT uuid_feature_alias, count(*) AS n FROM sample GROUP BY 1)
SELECT fa.uuid, fa.kind, coalesce(max(u.n), 0) AS n_samples, count(f.uuid) AS n_clashes FROM feature_alias fa LEFT JOIN u ON u.uuid_feature_alias = fa.uuid
LEFT JOIN feature f ON lower(f.name) = fa.alias_key AND f.uuid IS DISTINCT FROM fa.uuid_feature GROUP BY 1, 2""",
)
def alias_usage(r: Roles) -> DataFrame:
    return m.alias_usage(r.feature_alias, r.sample, r.feature)


@query(
    "d33_activity_window",
    """SELECT f.uuid, count(s.uuid) AS n_samples, CAST(min(CAST(s.datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE)) AS VARCHAR) AS first_day,
  CAST(max(CAST(s.datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE)) AS VARCHAR) AS last_day
FROM feature f LEFT JOIN feature_alias fa ON fa.uuid_feature = f.uuid AND fa.kind = 'self' LEFT JOIN sample s ON s.uuid_feature_alias = fa.uuid GROUP BY 1""",
)
def activity_window(r: Roles) -> DataFrame:
    a = m.activity_window(r.feature, r.feature_alias, r.sample)
    return a.select("uuid", "n_samples", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"))


@query(
    "g03_natural_order",
    """SELECT point, row_number() OVER (ORDER BY TRY_CAST(regexp_extract(point, '^(\\d+)', 1) AS INTEGER) NULLS FIRST, regexp_replace(point, '^\\d+', ''), point) AS place
FROM (SELECT DISTINCT p_size || p_type AS point FROM part)""",
)
def natural_order(r: Roles) -> DataFrame:
    """Points (a registry dimension of at most sizes times types) by number, then suffix."""
    from pyspark.sql import Window

    p = r.table("part").select(F.concat(F.col("p_size").cast("string"), "p_type").alias("point")).distinct()
    order = Window.orderBy(F.nullif(F.regexp_extract("point", r"^(\d+)", 1), F.lit("")).cast("int").asc_nulls_first(), F.regexp_replace("point", r"^\d+", ""), "point")
    return p.select("point", F.row_number().over(order).cast("long").alias("place"))


@query("g05_sites_by_length", "SELECT site, row_number() OVER (ORDER BY length(site) DESC, site) AS place FROM (SELECT DISTINCT trim(site) AS site FROM feature WHERE site <> '')")
def sites_by_length(r: Roles) -> DataFrame:
    from pyspark.sql import Window

    from ..operators.resolve import sites_by_length as sites

    return sites(r.feature).select("site", F.row_number().over(Window.orderBy(F.length("site").desc(), "site")).cast("long").alias("place"))


@query(
    "b05_snapshot_retention",
    """SELECT CAST(day AS VARCHAR) AS day, date_diff('day', day, DATE '2001-08-02') <= 60 OR day = max(day) OVER (PARTITION BY strftime(day, '%Y-%m')) AS keep FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""",
)
def snapshot_retention(r: Roles) -> DataFrame:
    days = r.table("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return reg.retained(days, F.lit("2001-08-02").cast("date")).select(F.col("day").cast("string").alias("day"), "keep")


@query("h01_units_union", "SELECT DISTINCT uuid_analyte, units FROM (SELECT uuid_analyte, units FROM lab_method UNION SELECT uuid, units FROM analyte) WHERE units IS NOT NULL")
def units_union(r: Roles) -> DataFrame:
    return reg.units_drift(r.lab_method, r.analyte.select(F.col("uuid").alias("uuid_analyte"), "units"), "uuid_analyte", "units")


@query(
    "h05_key_sets",
    """SELECT (SELECT count(*) FROM (SELECT uuid_feature FROM mask EXCEPT SELECT uuid_feature FROM feature_alias)) AS only_mask,
  (SELECT count(*) FROM (SELECT uuid_feature FROM mask INTERSECT SELECT uuid_feature FROM feature_alias)) AS both,
  (SELECT count(*) FROM (SELECT uuid_feature FROM mask UNION SELECT uuid_feature FROM feature_alias)) AS either""",
)
def key_sets(r: Roles) -> DataFrame:
    a, b = r.mask.select("uuid_feature"), r.feature_alias.select("uuid_feature")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(a.subtract(b), "only_mask").join(n(a.intersect(b), "both"), F.lit(True)).join(n(a.union(b).distinct(), "either"), F.lit(True))


@query(
    "h06_requirement_grid",
    """WITH p AS (SELECT c_nationkey AS k, c_mktsegment AS m, c_custkey AS point FROM customer WHERE c_acctbal > 0), a AS (SELECT p_size % 25 AS k, p_type AS analyte FROM part WHERE p_partkey % 3 = 0 GROUP BY 1, 2)
SELECT point, analyte, CAST(max(3 + length(m)) AS INTEGER) AS required FROM p JOIN a USING (k) GROUP BY 1, 2""",
)
def requirement_grid(r: Roles) -> DataFrame:
    """Rules for the points of each nation and segment, at most 50 in one, and the analytes that the nation asks for."""
    of = r.table("part").where("p_partkey % 3 = 0").groupBy((F.col("p_size") % 25).alias("k")).agg(F.collect_set("p_type").alias("analytes"))
    rules = r.table("customer").where("c_acctbal > 0").groupBy(F.col("c_nationkey").alias("k"), "c_mktsegment", F.floor(F.col("c_custkey") / 50)).agg(F.collect_list("c_custkey").alias("points"))
    return st.requirement_grid(rules.join(of, "k").withColumn("required", 3 + F.length("c_mktsegment")))


@query("d36_view_diff", f"WITH {RANKED} SELECT a_uuid AS k, 'differs' AS kind FROM ranked WHERE preference_rank > 1 UNION ALL SELECT a.uuid, 'only_right' FROM analysis a WHERE NOT EXISTS (SELECT 1 FROM ranked WHERE a_uuid = a.uuid)")
def view_diff(r: Roles) -> DataFrame:
    left = ranked(r).select(F.col("a_uuid").alias("uuid"), F.col("preference_rank").cast("int").alias("rank"))
    return reg.full_diff(left, r.analysis.select("uuid", F.lit(1).alias("rank")), "uuid", ["rank"])


