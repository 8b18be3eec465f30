"""Queries of scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, units, values
from .registry import query
from .roles import Roles


@query(
    "j01_parse_value",
    r"""
WITH t AS (SELECT row, value_raw, trim(value_raw) AS t FROM raw),
b AS (SELECT *, CASE WHEN t[1] IN ('<', '>') THEN trim(substr(t, 2)) ELSE t END AS body,
  CASE WHEN t = '' THEN 'empty' WHEN t = 'NS' THEN 'no_sample' WHEN regexp_full_match(t, '-+') THEN 'not_computable' END AS skip_reason FROM t),
n AS (SELECT *, regexp_full_match(body, '[+-]?[0-9]{1,3}(,[0-9]{1,3})+(\.[0-9]+)?') AND NOT regexp_full_match(body, '[+-]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?') AS amb FROM b),
v AS (SELECT *, CASE WHEN NOT amb AND regexp_full_match(replace(body, ',', ''), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN CAST(replace(body, ',', '') AS DOUBLE) END AS num FROM n)
SELECT row,
  CASE WHEN skip_reason IS NULL AND t <> 'BDL' THEN num END AS value_num,
  CASE WHEN skip_reason IS NULL AND t <> 'BDL' AND t[1] NOT IN ('<', '>') AND num IS NULL AND NOT amb THEN t END AS value_chr,
  CASE WHEN skip_reason IS NOT NULL THEN NULL WHEN t = 'BDL' OR (t[1] IN ('<', '>') AND num IS NOT NULL) THEN FALSE WHEN num IS NOT NULL THEN TRUE END AS quantified,
  CASE WHEN t[1] = '<' THEN num END AS rl_low, CASE WHEN t[1] = '>' THEN num END AS rl_high, skip_reason,
  CASE WHEN skip_reason IS NULL AND amb THEN 'ambiguous_number_format' WHEN skip_reason IS NULL AND t[1] IN ('<', '>') AND num IS NULL THEN 'unparseable_limit_value' END AS parse_error
FROM v
""",
)
def parse_value(r: Roles) -> DataFrame:
    return r.raw.select("row", values.parse_value(F.col("value_raw")).alias("p")).select("row", "p.*")


@query(
    "j02_normalise_lab_text",
    """
SELECT doc_id, md5(replace(replace(replace(replace(replace(text, 'e', '¡'), 'th', 'Âµ'), '¡', '°'), 'Â°', '°'), 'Âµ', 'µ')) AS fixed_md5,
  contains(text, chr(65533)) AS irrecoverable FROM documents
""",
)
def normalise_lab_text(r: Roles) -> DataFrame:
    damaged = F.replace(F.replace("text", F.lit("e"), F.lit("¡")), F.lit("th"), F.lit("Âµ"))
    return r.table("documents").select("doc_id", F.md5(text.normalise_lab_text(damaged)).alias("fixed_md5"), text.is_irrecoverable(F.col("text")).alias("irrecoverable"))


@query(
    "j03_method_key",
    r"""SELECT item_id, nullif(lower(regexp_replace(text, '[^\p{L}\p{Nd}]', '', 'g')), '') AS key
FROM benchmark""",
)
def method_key(r: Roles) -> DataFrame:
    return r.table("benchmark").select("item_id", text.method_key(F.col("text")).alias("key"))


@query(
    "j04_feature_key",
    r"""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN NULL ELSE lower(replace(c_name, '#', '.')) END AS key FROM customer""",
)
def feature_key(r: Roles) -> DataFrame:
    k = F.col("c_custkey") % 3
    name = F.when(k == 0, F.lit("  .- ")).when(k == 1, F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("\t"))).otherwise(F.replace("c_name", F.lit("#"), F.lit(".")))
    return r.table("customer").select("c_custkey", text.feature_key(name).alias("key"))


@query("j05_canonical_point", r"SELECT c_custkey, regexp_replace(upper(c_name), '(^|[^0-9])0+([0-9])', '\1\2', 'g') AS point FROM customer")
def canonical_point(r: Roles) -> DataFrame:
    return r.table("customer").select("c_custkey", text.canonical_point(F.col("c_name")).alias("point"))


@query("j07_squish_key", r"SELECT doc_id, md5(lower(trim(regexp_replace(text, '[\t\n\v\f\r ]+', ' ', 'g')))) AS key_md5 FROM documents")
def squish_key(r: Roles) -> DataFrame:
    return r.table("documents").select("doc_id", F.md5(text.squish_key(F.col("text"))).alias("key_md5"))


FILENAME = "CASE o_orderkey % 4 WHEN 0 THEN 'PROJ.' ELSE '' END || 'XX' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_' || (o_orderkey % 5) || '_XTAB' ELSE '-old' END || '.csv'"


def filename() -> F.Column:
    k = F.col("o_orderkey")
    tail = F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("_"), (k % 5).cast("string"), F.lit("_XTAB"))).otherwise("-old")
    return F.concat(F.when(k % 4 == 0, "PROJ.").otherwise(""), F.lit("XX"), F.lpad(k.cast("string"), 7, "0"), tail, F.lit(".csv"))


@query(
    "j08_work_order_revision",
    rf"""SELECT f AS filename, nullif(regexp_extract(f, '([A-Z]{{2}}\d{{7}})', 1), '') AS work_order,
  TRY_CAST(regexp_extract(f, '[A-Z]{{2}}\d{{7}}_(\d+)[_.]', 1) AS INTEGER) AS revision FROM (SELECT {FILENAME} AS f FROM orders)""",
)
def work_order_revision(r: Roles) -> DataFrame:
    f = r.table("orders").select(filename().alias("filename"))
    return f.select("filename", text.guess_work_order(F.col("filename")).alias("work_order"), text.guess_revision(F.col("filename")).alias("revision"))


PHRASES = ("Clear, low flow", "not flowing, slightly cloudy", "HIGH EVEL", "dry", "Mod dis / turbid", "pooled then dry", "very  low levels", "nothing to say")


@query(
    "j12_observation",
    """
WITH said AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'Clear, low flow' WHEN 1 THEN 'not flowing, slightly cloudy' WHEN 2 THEN 'HIGH EVEL' WHEN 3 THEN 'dry'
  WHEN 4 THEN 'Mod dis / turbid' WHEN 5 THEN 'pooled then dry' WHEN 6 THEN 'very  low levels' ELSE 'nothing to say' END AS remark FROM events)
SELECT event_id, remark, CASE event_id % 8 WHEN 0 THEN 'Low flow' WHEN 1 THEN 'No discharge' WHEN 2 THEN 'High level' WHEN 3 THEN 'Dry'
  WHEN 4 THEN 'Mod discharge' WHEN 5 THEN 'Pooled' WHEN 6 THEN 'Very low level' END AS stage,
  CASE event_id % 8 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Slightly cloudy' WHEN 4 THEN 'Turbid' END AS appearance FROM said
""",
)
def observation(r: Roles) -> DataFrame:
    said = F.get(F.array(*[F.lit(p) for p in PHRASES]), (F.col("event_id") % 8).cast("int"))
    df = r.table("events").select("event_id", said.alias("remark"))
    return df.withColumn("o", text.observation(F.col("remark"))).select("event_id", "remark", "o.*")


@query(
    "j16_report_numbers",
    r"""
WITH t AS (SELECT o_custkey, string_agg('ES' || lpad(CAST(o_orderkey % 9000000 AS VARCHAR), 7, '0'), ' and ' ORDER BY o_orderkey) AS said FROM orders GROUP BY 1)
SELECT o_custkey, list_aggregate(regexp_extract_all(said, 'ES[0-9]{7}'), 'string_agg', ',') AS numbers FROM t
""",
)
def report_numbers(r: Roles) -> DataFrame:
    said = F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.concat(F.lit("ES"), F.lpad((k % 9000000).cast("string"), 7, "0")))
    g = r.table("orders").groupBy("o_custkey").agg(F.array_join(said, " and ").alias("said"))
    return g.select("o_custkey", F.array_join(text.report_numbers(F.col("said")), ",").alias("numbers"))


@query(
    "j17_token_split",
    r"""
WITH t AS (SELECT doc_id, trim(unnest(string_split(text, ','))) AS token FROM documents)
SELECT CASE WHEN regexp_matches(token, '\d') THEN 'digit' WHEN regexp_matches(token, '\s') THEN 'phrase' ELSE 'word' END AS kind, count(*) AS n, count(DISTINCT token) AS n_distinct
FROM t WHERE token <> '' GROUP BY 1
""",
)
def token_split(r: Roles) -> DataFrame:
    t = r.table("documents").select(F.explode(text.tokens(F.col("text"))).alias("token"))
    kind = F.when(F.col("token").rlike(r"\d"), "digit").when(F.col("token").rlike(r"\s"), "phrase").otherwise("word")
    return t.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.countDistinct("token").alias("n_distinct"))


@query(
    "j20_unit_long_form",
    """SELECT uuid, units, CASE units WHEN 'mg/L' THEN 'milligrams per litre' WHEN 'ug/L' THEN 'micrograms per litre' WHEN 'uS/cm' THEN 'microsiemens per centimetre' ELSE units END AS long_form
FROM lab_method""",
)
def unit_long_form(r: Roles) -> DataFrame:
    return r.lab_method.select("uuid", "units", text.unit_long_form(F.col("units")).alias("long_form"))


@query("j19_reported_as", r"SELECT p_partkey, nullif(regexp_extract(p_name || ' as ' || p_type, '(?i)\sas\s+(\w+)$', 1), '') AS species FROM part")
def reported_as(r: Roles) -> DataFrame:
    return r.table("part").select("p_partkey", text.reported_as(F.concat("p_name", F.lit(" as "), "p_type")).alias("species"))


@query(
    "k01_parse_lab_datetime",
    """
WITH t AS (SELECT event_id, date_trunc('minute', ts) AS local FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(local, '%d %b %Y %H:%M') WHEN 1 THEN strftime(local, '%d-%b-%y') WHEN 2 THEN strftime(local, '%d-%b-%y %H:%M') ELSE '32/13/2025' END AS said,
  CAST(CASE WHEN event_id % 4 = 3 THEN NULL ELSE (CASE event_id % 4 WHEN 1 THEN date_trunc('day', local) ELSE local END) AT TIME ZONE 'Australia/Sydney' AT TIME ZONE 'UTC' END AS VARCHAR) AS utc
FROM t
""",
)
def parse_lab_datetime(r: Roles) -> DataFrame:
    k, ts = F.col("event_id") % 4, F.col("ts").cast("timestamp_ntz")
    said = F.when(k == 0, F.date_format(ts, "dd MMM yyyy HH:mm")).when(k == 1, F.date_format(ts, "dd-MMM-yy")).when(k == 2, F.date_format(ts, "dd-MMM-yy HH:mm")).otherwise("32/13/2025")
    df = r.table("events").select("event_id", said.alias("said"))
    return df.select("event_id", "said", dates.parse_lab_datetime(F.col("said"), "esdat").cast("string").alias("utc"))


#: What follows a complete date is ignored, as with "noon".
SAID = """t AS (SELECT event_id, date_trunc('minute', ts) AS local FROM events),
said AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(local, '%d %b %Y %H:%M') WHEN 1 THEN strftime(local, '%d-%b-%y') WHEN 2 THEN strftime(local, '%Y-%m-%d %H:%M') WHEN 3 THEN strftime(local, '%Y-%m-%d')
  WHEN 4 THEN strftime(local, '%Y-%m-%d') || ' noon' ELSE '32/13/2025' END AS said FROM t)"""


@query(
    "k05_sampled",
    f"""WITH {SAID}, p AS (SELECT *, coalesce(try_strptime(said, '%d %b %Y %H:%M'), try_strptime(said, '%d-%b-%y'), try_strptime(said, '%Y-%m-%d %H:%M'), try_strptime(left(said, 10), '%Y-%m-%d')) AS local FROM said)
SELECT event_id, said, CAST(CAST(local AS DATE) AS VARCHAR) AS day, CAST(CASE WHEN contains(said, ':') THEN local AT TIME ZONE 'Australia/Sydney' AT TIME ZONE 'UTC' END AS VARCHAR) AS utc,
  CASE WHEN local IS NULL THEN 'parse_error/datetime' END AS review FROM p""",
)
def sampled(r: Roles) -> DataFrame:
    k, ts = F.col("event_id") % 6, F.col("ts").cast("timestamp_ntz")
    form = lambda f: F.date_format(ts, f)
    said = F.when(k == 0, form("dd MMM yyyy HH:mm")).when(k == 1, form("dd-MMM-yy")).when(k == 2, form("yyyy-MM-dd HH:mm")).when(k == 3, form("yyyy-MM-dd")).when(k == 4, F.concat(form("yyyy-MM-dd"), F.lit(" noon"))).otherwise("32/13/2025")
    at = dates.sampled(F.col("said"))
    rows = r.table("events").select("event_id", said.alias("said")).withColumn("at", at)
    review = F.when(F.col("at.date").isNull(), "parse_error/datetime")
    return rows.select("event_id", "said", F.col("at.date").cast("string").alias("day"), F.col("at.datetime").cast("string").alias("utc"), review.alias("review"))


@query("k03_has_clock_time", r"SELECT value_raw, count(*) AS n, bool_or(regexp_matches(value_raw || ' 10:30', '\d{1,2}:\d{2}')) AS with_time, bool_or(regexp_matches(value_raw, '\d{1,2}:\d{2}')) AS plain FROM raw GROUP BY 1")
def clock_time(r: Roles) -> DataFrame:
    v = F.col("value_raw")
    return r.raw.groupBy("value_raw").agg(
        F.count("*").alias("n"), F.bool_or(dates.has_clock_time(F.concat(v, F.lit(" 10:30")))).alias("with_time"), F.bool_or(dates.has_clock_time(v)).alias("plain")
    )


@query("k04_excel_date", "SELECT o_orderkey, CAST(DATE '1899-12-30' + CAST(floor(o_totalprice / 10) AS INTEGER) AS VARCHAR) AS day FROM orders")
def excel_date(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", dates.excel_date(F.col("o_totalprice") / 10).cast("string").alias("day"))


@query("k08_civil_date", "SELECT uuid, CAST(CAST(datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE) AS VARCHAR) AS day FROM sample")
def civil_date(r: Roles) -> DataFrame:
    return r.sample.select("uuid", dates.civil_date(F.col("datetime")).cast("string").alias("day"))


@query(
    "l01_unify_value",
    """
WITH dims(u, d, f) AS (VALUES ('mg/L', 'c', 1e-3), ('ug/L', 'c', 1e-6), ('g/L', 'c', 1.0), ('uS/cm', 's', 1e-4), ('mS/cm', 's', 0.1))
SELECT m.uuid, m.units AS units_from, a.units AS units_to,
  CASE WHEN m.units IS NULL OR m.units = a.units THEN m.rl_low WHEN x.d = y.d THEN round(m.rl_low * x.f / y.f, 6) END AS converted,
  CASE WHEN m.units IS NOT NULL AND m.units <> a.units AND x.d <> y.d THEN 'unknown_unit' END AS error,
  CASE WHEN m.units IS NOT NULL THEN x.d = y.d END AS compatible
FROM lab_method m JOIN analyte a ON m.uuid_analyte = a.uuid LEFT JOIN dims x ON m.units = x.u LEFT JOIN dims y ON a.units = y.u
""",
)
def unify_value(r: Roles) -> DataFrame:
    a = r.analyte.select(F.col("uuid").alias("uuid_analyte"), F.col("units").alias("units_to"))
    df = r.lab_method.withColumnRenamed("units", "units_from").join(a, "uuid_analyte")
    c = units.convert(F.col("rl_low"), F.col("units_from"), F.col("units_to"))
    return df.withColumn("c", c).select(
        "uuid", "units_from", "units_to",
        F.when(F.col("units_from").isNull() | (F.col("units_from") == F.col("units_to")), F.col("c.value")).otherwise(F.round("c.value", 6)).alias("converted"),
        F.col("c.error").alias("error"), units.compatible(F.col("units_from"), F.col("units_to")).alias("compatible"),
    )


@query(
    "l09_corrected_flag",
    "SELECT uuid, NOT coalesce(value <= rl_low, FALSE) AS quantified FROM analysis",
)
def corrected_flag(r: Roles) -> DataFrame:
    return r.analysis.select("uuid", values.corrected_flag(F.col("value"), F.col("rl_low"), F.lit(None).cast("double")).alias("quantified"))


@query(
    "l13_residual_classes",
    """
SELECT CASE WHEN quantified IS NULL AND value IS NOT NULL THEN 'B_NA' WHEN NOT quantified AND value IS NULL THEN 'BDL_EQ' WHEN NOT quantified AND value = rl_low THEN 'A1'
  WHEN NOT quantified AND value < rl_low THEN 'A2' WHEN NOT quantified THEN 'LEGIT_RAISED' ELSE 'DET_OK' END AS class, count(*) AS n FROM analysis GROUP BY 1
""",
)
def residual_classes(r: Roles) -> DataFrame:
    return r.analysis.groupBy(values.residual_class(F.col("quantified"), F.col("value"), F.col("rl_low")).alias("class")).agg(F.count("*").alias("n"))


@query(
    "c18_lab_kind",
    """
SELECT CASE WHEN method IN ('field', 'EN67 - Client Supplied Data') THEN 'field' WHEN organisation = 'ACIRL' AND method IS NULL THEN 'acirl_transcription'
  WHEN organisation = 'ACIRL' THEN 'acirl_own_lab' WHEN organisation = 'ALS' THEN 'als_lab' ELSE 'other_lab' END AS kind, count(*) AS n FROM lab_method GROUP BY 1
""",
)
def lab_kind(r: Roles) -> DataFrame:
    return r.lab_method.groupBy(values.lab_kind(F.lit(True), F.col("method"), F.col("organisation")).alias("kind")).agg(F.count("*").alias("n"))
