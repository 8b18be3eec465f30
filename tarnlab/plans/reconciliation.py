"""Queries of reconciliation, assembly, grids, reviews and streams of states."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, values
from ..operators import assemble as asm
from ..operators import grids, samples
from ..operators import reconcile as rc
from ..operators import registry as reg
from ..operators import reviews as rv
from ..operators import statistics as st
from ..sources import files as src
from ..warehouse import store
from .registry import query
from .roles import Roles

KIND = """CASE WHEN {m} IN ('field', 'EN67 - Client Supplied Data') THEN 'field' WHEN {o} = 'ACIRL' AND {m} IS NULL THEN 'acirl_transcription' WHEN {o} = 'ACIRL' THEN 'acirl_own_lab' WHEN {o} = 'ALS' THEN 'als_lab' ELSE 'other_lab' END"""


@query(
    "c01_quality_filter",
    """WITH t AS (SELECT row, CASE row % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Normal' WHEN 2 THEN 'LCS' WHEN 3 THEN 'MB' WHEN 4 THEN 'unknown' WHEN 5 THEN 'LAB_D' ELSE 'NCP' END AS st FROM raw)
SELECT coalesce(CASE WHEN st NOT IN ('Normal', 'unknown') THEN 'qc_' || st END, 'clean') AS reason, count(*) AS n FROM t GROUP BY 1""",
)
def quality_filter(r: Roles) -> DataFrame:
    kinds = F.array(*[F.lit(x) for x in (None, "Normal", "LCS", "MB", "unknown", "LAB_D", "NCP")])
    rows = r.raw.withColumn("sample_type", F.get(kinds, (F.col("row") % 7).cast("int")))
    return rc.counts(rc.quality_filter(rows).withColumn("reason", F.coalesce("skip_reason", F.lit("clean"))), "reason")


@query(
    "l06_units_cascade",
    r"""
WITH rng AS (SELECT m.uuid_analyte, count(*) AS n, min(a.value) AS low, max(a.value) AS high FROM analysis a JOIN lab_method m ON a.uuid_lab = m.uuid WHERE a.value > 0 AND m.uuid_analyte IS NOT NULL GROUP BY 1),
dims(u, d, f) AS (VALUES ('mg/L', 'c', 1e-3), ('ug/L', 'c', 1e-6), ('g/L', 'c', 1.0), ('uS/cm', 's', 1e-4), ('mS/cm', 's', 0.1)),
t AS (SELECT w.row, w.value_raw, trim(w.value_raw) AS t, m.uuid_analyte, m.uuid_analyte IS NULL AS pend, CASE WHEN w.row % 31 = 0 THEN '7.5' ELSE m.units END AS uf, an.units AS ut
  FROM raw w JOIN lab_method m ON m.uuid = 'lm' || (w.row % 200) LEFT JOIN analyte an ON m.uuid_analyte = an.uuid),
p AS (SELECT *, CASE WHEN t = '' THEN 'empty' WHEN t = 'NS' THEN 'no_sample' WHEN t = '---' THEN 'not_computable' END AS skip,
  CASE WHEN regexp_full_match(t, '\d{1,3},5') THEN 'ambiguous_number_format' WHEN t LIKE '%mg/L' THEN 'unparseable_limit_value' END AS err,
  CASE WHEN t = 'Clear, low flow' OR t LIKE '0x%' THEN t END AS chr,
  CASE WHEN regexp_full_match(t, '[<>]? ?[0-9]+') OR regexp_full_match(t, '1,[0-9]{3}') THEN CAST(regexp_replace(t, '[<>, ]', '', 'g') AS DOUBLE) END AS num FROM t),
c AS (SELECT p.*, rng.n, rng.low, rng.high, x.d AS xd, y.d AS yd, CASE WHEN uf IS NULL OR uf = ut THEN num WHEN x.d = y.d THEN num * x.f / y.f END AS v
  FROM p LEFT JOIN rng USING (uuid_analyte) LEFT JOIN dims x ON uf = x.u LEFT JOIN dims y ON ut = y.u),
o AS (SELECT row, CASE WHEN skip IS NOT NULL THEN skip WHEN err IS NOT NULL THEN err WHEN chr IS NOT NULL THEN 'text' WHEN pend THEN 'pending' WHEN uf = '7.5' THEN 'units_numeric'
  WHEN uf IS NOT NULL AND uf <> ut AND (xd IS NULL OR yd IS NULL OR xd <> yd) THEN 'unknown_unit' WHEN uf IS NULL AND ut IS NOT NULL THEN 'units_missing'
  WHEN v > 0 AND n >= 30 AND (v < low / 10 OR v > high * 10) THEN 'value' ELSE 'kept' END AS reason, v, num FROM c)
SELECT CASE WHEN reason IN ('empty', 'no_sample', 'not_computable') THEN 'skipped' WHEN reason IN ('text', 'pending', 'kept') THEN 'kept' ELSE 'review' END AS disposition, reason, count(*) AS n,
  round(sum(CASE WHEN reason = 'pending' THEN num WHEN reason = 'kept' THEN v END), 4) AS total FROM o GROUP BY 1, 2
""",
)
def units_cascade(r: Roles) -> DataFrame:
    an = r.analyte.select(F.col("uuid").alias("an"), F.col("units").alias("units_to"))
    lm = r.lab_method.select(F.col("uuid").alias("lm"), "uuid_analyte", F.col("units").alias("lm_units"))
    rows = r.raw.join(lm, F.col("lm") == F.concat(F.lit("lm"), (F.col("row") % 200).cast("string"))).join(an, F.col("uuid_analyte") == F.col("an"), "left")
    rows = rows.withColumn("units_raw", F.when(F.col("row") % 31 == 0, "7.5").otherwise(F.col("lm_units")))
    rows = rows.withColumn("parsed", values.parse_value(F.col("value_raw"))).withColumn("analyte_pending", F.col("uuid_analyte").isNull())
    out = rc.units_cascade(rows, st.value_ranges(r.analysis, r.lab_method))
    return out.groupBy("disposition", "reason").agg(F.count("*").alias("n"), F.round(F.sum("value_converted"), 4).alias("total"))


@query(
    "f06_method_preference",
    """SELECT source_ref, first_value(uuid_lab) OVER w AS kept_uuid_lab, coalesce(point IS NOT NULL AND date IS NOT NULL AND uuid_analyte IS NOT NULL AND uuid_lab <> first_value(uuid_lab) OVER w, FALSE) AS is_loser
FROM (SELECT i.* REPLACE (m.rl_low AS rl_low) FROM incoming i LEFT JOIN lab_method m ON i.uuid_lab = m.uuid) WINDOW w AS (PARTITION BY point, date, uuid_analyte, CASE WHEN point IS NULL OR date IS NULL OR uuid_analyte IS NULL THEN source_ref END ORDER BY rl_low ASC NULLS LAST, value DESC NULLS LAST, source_ref ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def method_preference(r: Roles) -> DataFrame:
    """The limits are those of the registered methods, not those that rows state."""
    limit = r.lab_method.select(F.col("uuid").alias("uuid_lab"), F.col("rl_low").alias("_limit"))
    rows = r.incoming.join(limit, "uuid_lab", "left").withColumn("rl_low", F.col("_limit"))
    return rc.method_preference(rows).select("source_ref", "kept_uuid_lab", "is_loser")


MATCH = """
pairs AS (SELECT i.row, e.uuid AS e_uuid, e.value AS ev, e.value_chr AS ec, e.quantified AS eq, e.revision AS er, coalesce(i.datetime IS NOT NULL AND e.datetime IS NOT NULL AND i.datetime <> e.datetime, FALSE) AS other,
  coalesce(i.datetime = e.datetime, FALSE) AS same FROM incoming i JOIN stored e ON i.point = e.point AND i.date = e.date AND i.uuid_lab = e.uuid_lab),
some_ AS (SELECT *, bool_and(other) OVER (PARTITION BY row) AS all_other FROM pairs),
matched AS (SELECT * FROM some_ WHERE NOT all_other QUALIFY row_number() OVER (PARTITION BY row ORDER BY same DESC, e_uuid) = 1)
"""


@query("d13_existing_match", f"WITH {MATCH} SELECT row, e_uuid FROM matched")
def existing_match(r: Roles) -> DataFrame:
    return rc.existing_match(r.incoming, r.stored).select("row", "e_uuid")


THREE_WAY = f"""{MATCH},
outcomes AS (SELECT i.*, m.e_uuid, CASE WHEN m.e_uuid IS NULL THEN 'new'
  WHEN i.quantified IS NOT DISTINCT FROM m.eq AND CASE WHEN i.value IS NOT NULL AND m.ev IS NOT NULL THEN abs(i.value * coalesce(i.conversion_constant, 1.0) - m.ev) <= 1e-9 * greatest(1.0, abs(i.value * coalesce(i.conversion_constant, 1.0)), abs(m.ev))
    WHEN i.value IS NULL AND m.ev IS NULL THEN i.value_chr IS NOT DISTINCT FROM m.ec ELSE FALSE END THEN 'already_present'
  WHEN i.revision > m.er THEN 'supersede' ELSE 'value_conflict' END AS outcome FROM incoming i LEFT JOIN matched m USING (row))
"""


@query("p07_three_way", f"WITH {THREE_WAY} SELECT row, e_uuid, outcome FROM outcomes")
def three_way(r: Roles) -> DataFrame:
    return rc.three_way(rc.with_existing(r.incoming, r.stored)).select("row", "e_uuid", "outcome")


@query("e21_outcome_counts", f"WITH {THREE_WAY} SELECT outcome, count(*) AS n FROM outcomes GROUP BY 1")
def outcome_counts(r: Roles) -> DataFrame:
    return rc.counts(rc.three_way(rc.with_existing(r.incoming, r.stored)), "outcome")


@query(
    "f07_batch_duplicates",
    """WITH b AS (SELECT *, row_number() OVER (PARTITION BY uuid_alias, date ORDER BY row) AS pos FROM incoming),
w AS (SELECT *, first_value(pos) OVER g AS p0, first_value(datetime) OVER g AS t0, min(pos) OVER (PARTITION BY uuid_alias, date, uuid_analyte, uuid_lab, CASE WHEN uuid_analyte IS NULL THEN pos END, datetime) AS pt FROM b
  WINDOW g AS (PARTITION BY uuid_alias, date, uuid_analyte, uuid_lab, CASE WHEN uuid_analyte IS NULL THEN pos END ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT row, CAST(nullif(CASE WHEN t0 IS NULL OR datetime IS NULL THEN p0 ELSE pt END, pos) AS INTEGER) AS duplicate_of FROM w""",
)
def batch_duplicates(r: Roles) -> DataFrame:
    rows = r.incoming.withColumn("pos", F.row_number().over(Window.partitionBy("uuid_alias", "date").orderBy("row")))
    return rc.batch_duplicates(rows, ["uuid_alias", "date", "uuid_analyte", "uuid_lab"]).select("row", "duplicate_of")


@query(
    "p08_twin_supersession",
    f"""WITH i AS (SELECT *, {KIND.format(m='method', o='organisation')} AS kind FROM incoming), e AS (SELECT *, {KIND.format(m='method', o='organisation')} AS kind FROM stored),
b AS (SELECT i.row, e.uuid, coalesce(i.datetime <> e.datetime, FALSE) AS other, coalesce(i.datetime = e.datetime, FALSE) AS same FROM i JOIN e ON i.point = e.point AND i.date = e.date AND i.uuid_analyte = e.uuid_analyte
  AND ((i.kind = 'acirl_transcription' AND e.kind = 'als_lab') OR (i.kind = 'als_lab' AND e.kind = 'acirl_transcription'))),
t AS (SELECT row, uuid FROM (SELECT *, bool_and(other) OVER (PARTITION BY row) AS ao FROM b) WHERE NOT ao QUALIFY row_number() OVER (PARTITION BY row ORDER BY same DESC, uuid) = 1)
SELECT i.row, t.uuid AS twin, CASE WHEN t.uuid IS NULL THEN 'none' WHEN i.kind = 'acirl_transcription' THEN 'skip' ELSE 'delete_twin' END AS action FROM i LEFT JOIN t USING (row)""",
)
def twin_supersession(r: Roles) -> DataFrame:
    kind = values.lab_kind(F.lit(True), F.col("method"), F.col("organisation"))
    out = rc.twin_supersession(r.incoming.withColumn("kind", kind), r.stored.withColumn("kind", kind))
    return out.select("row", "twin", "action")


#: Stored visits of every other order, and the incoming rows, by quarters, so that several samples share a point and a day.
VISITS = """
visits AS (SELECT s.uuid, coalesce(fa.uuid_feature, fa.uuid) AS point, CAST(date_trunc('quarter', CAST(s.stamp AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE)) AS DATE) AS date, s.datetime
  FROM sample s JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid WHERE CAST(substr(s.uuid, 2) AS BIGINT) % 2 = 0),
coming AS (SELECT row, point, CAST(date_trunc('quarter', date) AS DATE) AS date, datetime FROM incoming),
pairs AS (SELECT i.row, i.datetime AS t, v.uuid, v.datetime AS vt FROM coming i LEFT JOIN visits v ON i.point = v.point AND i.date = v.date),
seen AS (SELECT row, any_value(t) AS t, count(uuid) AS n, count(*) FILTER (uuid IS NOT NULL AND vt IS NULL) AS undated, count(*) FILTER (vt = t) AS same, min(uuid) FILTER (vt = t) AS same_uuid, min(uuid) AS least FROM pairs GROUP BY row),
judged AS (SELECT *, CASE WHEN n = 0 OR (t IS NOT NULL AND undated = 0 AND same = 0) THEN 'create' WHEN CASE WHEN same > 0 THEN same ELSE n END > 1 THEN 'refuse' ELSE 'reuse' END AS verdict FROM seen)
"""


def visits(r: Roles) -> DataFrame:
    s = r.sample.where(F.substring("uuid", 2, 20).cast("bigint") % 2 == 0).withColumnRenamed("uuid", "uuid_sample")
    out = s.join(r.feature_alias.select(F.col("uuid").alias("uuid_feature_alias"), "uuid_feature"), "uuid_feature_alias")
    return out.select(F.col("uuid_sample").alias("uuid"), F.coalesce("uuid_feature", "uuid_feature_alias").alias("point"), F.trunc(dates.civil_date(F.col("stamp")), "quarter").alias("date"), "datetime")


def coming(r: Roles) -> DataFrame:
    return r.incoming.select("row", "point", F.trunc("date", "quarter").alias("date"), "datetime")


@query(
    "d16_existing_samples",
    f"WITH {VISITS} SELECT row, verdict, CASE WHEN verdict = 'reuse' THEN CASE WHEN same > 0 THEN same_uuid ELSE least END END AS uuid_sample FROM judged",
)
def existing_samples(r: Roles) -> DataFrame:
    return samples.existing(coming(r), visits(r))


@query("d18_unmatched_rows", f"WITH {VISITS} SELECT row FROM judged WHERE verdict = 'create'")
def unmatched_rows(r: Roles) -> DataFrame:
    return samples.existing(coming(r), visits(r)).where("verdict = 'create'").select("row")


@query(
    "p24_merge_actions",
    """WITH l AS (SELECT * FROM analysis WHERE revision % 2 = 1), w AS (SELECT uuid_sample, uuid_lab, min(uuid) AS uuid FROM analysis WHERE revision % 2 = 0 GROUP BY 1, 2), ww AS (SELECT a.* FROM analysis a JOIN w USING (uuid))
SELECT l.uuid, CASE WHEN ww.uuid IS NULL THEN 'repoint' WHEN l.quantified IS NOT DISTINCT FROM ww.quantified AND CASE WHEN l.value IS NOT NULL AND ww.value IS NOT NULL THEN l.value = ww.value WHEN l.value IS NULL AND ww.value IS NULL THEN l.value_chr IS NOT DISTINCT FROM ww.value_chr ELSE FALSE END
  THEN 'drop_equal' ELSE 'review' END AS action FROM l LEFT JOIN ww ON l.uuid_lab = ww.uuid_lab AND l.uuid_sample = ww.uuid_sample""",
)
def merge_actions(r: Roles) -> DataFrame:
    from ..operators.joins import first_by

    even = first_by(r.analysis.where("revision % 2 = 0"), ["uuid_sample", "uuid_lab"], [F.col("uuid")])
    return reg.merge_actions(r.analysis.where("revision % 2 = 1"), even, ["uuid_sample", "uuid_lab"]).select("uuid", "action")


@query(
    "p13_find_or_create_samples",
    f"""WITH RECURSIVE {VISITS},
k AS (SELECT *, row_number() OVER (PARTITION BY point, date ORDER BY row) AS pos FROM (SELECT point, date, datetime, min(row) AS row FROM coming GROUP BY ALL)),
kept AS (SELECT point, date, list({{'u': uuid, 't': datetime}}) AS have FROM visits GROUP BY 1, 2),
steps AS (
  SELECT p.point, p.date, CAST(0 AS BIGINT) AS pos, coalesce(have, []) AS have, CAST(NULL AS VARCHAR) AS row, CAST(NULL AS TIMESTAMP) AS t, CAST(NULL AS VARCHAR) AS verdict, CAST(NULL AS VARCHAR) AS u FROM (SELECT DISTINCT point, date FROM k) p LEFT JOIN kept ON p.point = kept.point AND p.date = kept.date
  UNION ALL
  SELECT point, date, pos, CASE WHEN verdict = 'create' THEN list_append(have, {{'u': 'made ' || row, 't': t}}) ELSE have END, row, t, verdict,
    CASE verdict WHEN 'create' THEN 'made ' || row WHEN 'reuse' THEN left_[1].u END
  FROM (SELECT *, CASE WHEN len(have) = 0 OR (t IS NOT NULL AND len(same) = 0 AND len(list_filter(have, lambda h: h.t IS NULL)) = 0) THEN 'create' WHEN len(left_) > 1 THEN 'refuse' ELSE 'reuse' END AS verdict
    FROM (SELECT *, CASE WHEN len(same) > 0 THEN same ELSE have END AS left_ FROM (
      SELECT s.point, s.date, k.pos, s.have, k.row, k.datetime AS t, list_filter(s.have, lambda h: coalesce(h.t = k.datetime, FALSE)) AS same
      FROM steps s JOIN k ON k.point = s.point AND k.date = s.date AND k.pos = s.pos + 1))))
SELECT c.point, c.date, count(*) FILTER (verdict = 'refuse') AS n_refused, count(*) FILTER (u LIKE 'made %') AS n_of_new, count(DISTINCT u) FILTER (u LIKE 'made %') AS n_made,
  count(*) FILTER (u NOT LIKE 'made %') AS n_of_old, min(u) FILTER (u NOT LIKE 'made %') AS least
  FROM coming c JOIN steps s ON c.point = s.point AND c.date = s.date AND c.datetime IS NOT DISTINCT FROM s.t AND s.pos > 0 GROUP BY 1, 2""",
)
def find_or_create_samples(r: Roles) -> DataFrame:
    """The SQL takes the instants of each visit one by one."""
    out = samples.assigned(coming(r), visits(r), "made ")
    new = F.col("uuid_sample").like("made %")
    return out.groupBy("point", "date").agg(
        F.count_if(F.col("verdict") == "refuse").alias("n_refused"), F.count_if(new).alias("n_of_new"), F.countDistinct(F.when(new, F.col("uuid_sample"))).alias("n_made"), F.count_if(~new).alias("n_of_old"),
        F.min(F.when(~new, F.col("uuid_sample"))).alias("least"),
    )


@query(
    "p37_update_log",
    """WITH x AS (SELECT uuid, CAST(value AS VARCHAR) AS o1, CAST(CASE WHEN revision = 3 THEN value + 1 ELSE value END AS VARCHAR) AS n1, value_chr AS o2, CASE WHEN revision = 7 THEN 'Wet' ELSE value_chr END AS n2 FROM analysis)
SELECT uuid, 'value' AS field, o1 AS old, n1 AS new FROM x WHERE o1 IS DISTINCT FROM n1 UNION ALL SELECT uuid, 'value_chr', o2, n2 FROM x WHERE o2 IS DISTINCT FROM n2""",
)
def update_log(r: Roles) -> DataFrame:
    rows = r.analysis.select(
        "uuid", F.col("value").cast("string").alias("o1"), F.when(F.col("revision") == 3, F.col("value") + 1).otherwise(F.col("value")).cast("string").alias("n1"),
        F.col("value_chr").alias("o2"), F.when(F.col("revision") == 7, "Wet").otherwise(F.col("value_chr")).alias("n2"),
    )
    each = F.stack(F.lit(2), F.lit("value"), F.col("o1"), F.col("n1"), F.lit("value_chr"), F.col("o2"), F.col("n2"))
    return rows.select("uuid", each.alias("field", "old", "new")).where(~F.col("old").eqNullSafe(F.col("new")))


FILES = """
files AS (SELECT 'h' || o_orderkey AS hash, CASE WHEN o_orderkey % 17 <> 0 THEN 'WO' || o_custkey END AS home, CASE o_orderkey % 5 WHEN 0 THEN 'esdat/1.0' WHEN 1 THEN 'als_enmrg/1.0' WHEN 2 THEN 'als_xtab/1.0' WHEN 3 THEN 'acirl_field_xlsx/1.0' ELSE 'other/2' END AS adapter,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 3 END AS revision, o_orderkey AS pos, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE 5 END AS n_results FROM orders)
"""


def event_files(r: Roles) -> DataFrame:
    k = F.col("o_orderkey")
    names = F.array(*[F.lit(x) for x in ("esdat/1.0", "als_enmrg/1.0", "als_xtab/1.0", "acirl_field_xlsx/1.0", "other/2")])
    return r.table("orders").select(
        F.concat(F.lit("h"), k.cast("string")).alias("hash"), F.when(k % 17 != 0, F.concat(F.lit("WO"), F.col("o_custkey").cast("string"))).alias("home"),
        F.get(names, (k % 5).cast("int")).alias("adapter"), F.when(k % 4 != 0, k % 3).alias("revision"), k.alias("pos"), F.when(k % 9 == 0, 0).otherwise(5).alias("n_results"),
    )


@query(
    "p04_best_source",
    f"""WITH {FILES}, e AS (SELECT *, coalesce('wo::' || home, '__orphan__::' || hash) AS event, adapter LIKE 'acirl_field_xlsx/%' AS ex FROM files),
c AS (SELECT *, NOT ex AND n_results > 0 AS comp, CASE split_part(adapter, '/', 1) WHEN 'esdat' THEN 3 WHEN 'als_enmrg' THEN 2 WHEN 'als_xtab' THEN 1 ELSE 0 END AS rk FROM e)
SELECT event, hash, CASE WHEN ex THEN TRUE WHEN comp THEN row_number() OVER (PARTITION BY event, comp ORDER BY rk DESC, revision DESC NULLS LAST, pos) = 1 ELSE FALSE END AS kept FROM c""",
)
def best_source(r: Roles) -> DataFrame:
    f = event_files(r).withColumn("event", asm.event_id(F.col("home"), F.col("hash")))
    return asm.best_source(f).select("event", "hash", "kept")


@query(
    "p04_foreign_rows",
    """WITH t AS (SELECT CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE 'WO' || (l_orderkey % 3) END AS work_order, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE 'WO' || (l_partkey % 3) END AS home, CASE WHEN l_linenumber = 2 THEN 'NCP' WHEN l_linenumber = 3 THEN NULL ELSE 'Normal' END AS st FROM lineitem)
SELECT CASE WHEN work_order IS NULL OR home IS NULL OR work_order = home THEN 'own' WHEN st = 'NCP' THEN 'dropped_ncp' ELSE 'needs_review' END AS disposition, count(*) AS n FROM t GROUP BY 1""",
)
def foreign_rows(r: Roles) -> DataFrame:
    wo = lambda c: F.concat(F.lit("WO"), (F.col(c) % 3).cast("string"))
    line = F.col("l_linenumber")
    t = r.table("lineitem").select(
        F.when(F.col("l_orderkey") % 10 != 0, wo("l_orderkey")).alias("work_order"), F.when(F.col("l_partkey") % 7 != 0, wo("l_partkey")).alias("home"),
        F.when(line == 2, "NCP").when(line != 3, "Normal").alias("sample_type"),
    )
    return asm.flag_foreign(t).groupBy("disposition").agg(F.count("*").alias("n"))


@query(
    "d01_coalescing_join",
    """WITH res AS (SELECT 'x' || l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS row, CASE WHEN l_linenumber % 3 <> 0 THEN 's' || (l_orderkey % 5000) END AS sid, CASE WHEN l_linenumber <> 6 THEN 'Point  ' || (l_orderkey % 700) || ' ' END AS fr,
  CASE WHEN l_linenumber = 1 THEN 'me' END AS sampler, CASE WHEN l_linenumber = 2 THEN 'REG' END AS st FROM lineitem),
sam AS (SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 4 <> 3 THEN 's' || (o_orderkey % 4000) END AS sid, 'POINT ' || (o_orderkey % 500) AS fr, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS sampler, o_orderstatus AS st, o_orderdate AS dt FROM orders),
a AS (SELECT sid, arg_min(sampler, pos) FILTER (sampler IS NOT NULL) AS s1, arg_min(st, pos) FILTER (st IS NOT NULL) AS t1, count(DISTINCT CAST(dt AS DATE)) AS nd, count(DISTINCT st) AS nt FROM sam WHERE sid IS NOT NULL GROUP BY 1),
b AS (SELECT lower(trim(regexp_replace(fr, '\\s+', ' ', 'g'))) AS k, arg_min(sampler, pos) FILTER (sampler IS NOT NULL) AS s1, arg_min(st, pos) FILTER (st IS NOT NULL) AS t1, count(DISTINCT CAST(dt AS DATE)) AS nd, count(DISTINCT st) AS nt FROM sam WHERE fr IS NOT NULL GROUP BY 1)
SELECT row, coalesce(sampler, s1) AS sampler, coalesce(t1, st) AS sample_type, coalesce(nd > 1, FALSE) AS datetime_mismatch, coalesce(nt > 1, FALSE) AS type_mismatch FROM res LEFT JOIN a USING (sid) WHERE sid IS NOT NULL
UNION ALL SELECT row, coalesce(sampler, s1), coalesce(t1, st), coalesce(nd > 1, FALSE), coalesce(nt > 1, FALSE) FROM res LEFT JOIN b ON lower(trim(regexp_replace(res.fr, '\\s+', ' ', 'g'))) = b.k WHERE sid IS NULL""",
)
def coalescing_join(r: Roles) -> DataFrame:
    line, key = F.col("l_linenumber"), F.col("l_orderkey")
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    res = r.table("lineitem").select(
        F.concat(F.lit("x"), F.concat_ws("-", *parts)).alias("row"), F.when(line % 3 != 0, F.concat(F.lit("s"), (key % 5000).cast("string"))).alias("lab_sample_id"),
        F.when(line != 6, F.concat(F.lit("Point  "), (key % 700).cast("string"), F.lit(" "))).alias("feature_raw"), F.when(line == 1, "me").alias("sampler"), F.when(line == 2, "REG").alias("sample_type"),
    )
    k = F.col("o_orderkey")
    sam = r.table("orders").select(
        k.alias("pos"), F.when(k % 4 != 3, F.concat(F.lit("s"), (k % 4000).cast("string"))).alias("lab_sample_id"), F.concat(F.lit("POINT "), (k % 500).cast("string")).alias("feature_raw"),
        F.when(k % 2 == 0, F.col("o_orderpriority")).alias("sampler"), F.col("o_orderstatus").alias("sample_type"), F.col("o_orderdate").alias("sample_datetime"),
    )
    return asm.join_samples(res, sam, ["sampler"]).select("row", "sampler", "sample_type", "datetime_mismatch", "type_mismatch")


@query("e31_unanimous_work_order", f"WITH {FILES} SELECT pos % 9000 AS folder, min(home) AS home FROM files GROUP BY 1 HAVING count(DISTINCT home) = 1")
def unanimous_work_order(r: Roles) -> DataFrame:
    return asm.unanimous(event_files(r).withColumn("folder", F.col("pos") % 9000), "folder", "home")


CELLS = """
cells AS (SELECT 'u' || user_id AS file, event_id AS r, event_type, CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'signup' THEN 'Exposure Days' WHEN event_type = 'error' THEN 'Matrix: ' || CASE WHEN event_id % 3 = 0 THEN 'SOIL' ELSE 'WATER' END ELSE event_type || event_id END AS v FROM events)
"""


def cells(r: Roles) -> DataFrame:
    kind = F.col("event_type")
    v = (
        F.when(kind == "view", "").when(kind == "signup", "Exposure Days")
        .when(kind == "error", F.concat(F.lit("Matrix: "), F.when(F.col("event_id") % 3 == 0, "SOIL").otherwise("WATER")))
        .otherwise(F.concat(kind, F.col("event_id").cast("string")))
    )
    return r.table("events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file"), F.col("event_id").alias("r"), kind, v.alias("v"))


@query("f10_carried_headers", f"WITH {CELLS} SELECT file, r, last_value(CASE WHEN trim(v) <> '' THEN v END IGNORE NULLS) OVER (PARTITION BY file ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM cells")
def carried_headers(r: Roles) -> DataFrame:
    return cells(r).select("file", "r", grids.carried(F.col("v"), ["file"], "r").alias("carried"))


@query(
    "f12_sections",
    f"""WITH {CELLS} SELECT file, r, sum(CASE WHEN v LIKE 'Matrix:%' THEN 1 ELSE 0 END) OVER w AS section, coalesce(last_value(CASE WHEN v LIKE 'Matrix:%' THEN v LIKE '%WATER' END IGNORE NULLS) OVER w, FALSE) AS in_section
FROM cells WINDOW w AS (PARTITION BY file ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def sections(r: Roles) -> DataFrame:
    out = grids.sections(cells(r), ["file"], F.col("v").startswith("Matrix:"), F.col("v").endswith("WATER"))
    return out.select("file", "r", "section", "in_section")


@query(
    "f13_blocks_and_occurrences",
    f"""WITH {CELLS} SELECT file, r, coalesce(sum(CASE WHEN v = 'Exposure Days' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS block,
  CAST(row_number() OVER (PARTITION BY file, event_type ORDER BY r) AS INTEGER) AS occurrence FROM cells""",
)
def blocks_and_occurrences(r: Roles) -> DataFrame:
    c = cells(r)
    return c.select("file", "r", grids.blocks(F.col("v") == "Exposure Days", ["file"], "r").alias("block"), grids.occurrence(["file", "event_type"], "r").alias("occurrence"))


@query(
    "g08_values_beside_key",
    f"""WITH {CELLS}, g AS (SELECT file, '' AS sheet, r // 7 AS r, r % 7 AS c, v FROM cells), k AS (SELECT file, arg_min(r, c * 1000000 + r) AS kr, min(c) AS kc FROM g WHERE v = 'Exposure Days' GROUP BY 1)
SELECT file, string_agg(v, '|' ORDER BY c) AS beside FROM g JOIN k USING (file) WHERE r = kr AND c > kc AND trim(v) <> '' GROUP BY 1""",
)
def values_beside_key(r: Roles) -> DataFrame:
    g = cells(r).select("file", F.lit("").alias("sheet"), F.floor(F.col("r") / 7).alias("r"), (F.col("r") % 7).alias("c"), "v")
    return grids.beside(g, "^Exposure Days$").select("file", F.array_join("values", "|").alias("beside"))


@query(
    "i10_column_remarks",
    f"""WITH {CELLS} SELECT file, r % 5 AS c, string_agg(trim(v) || CASE WHEN r % 4 = 0 THEN ' dry' ELSE '' END, '; ' ORDER BY r) AS comments, CASE WHEN count(*) FILTER (r % 4 = 0) > 0 THEN 'Dry' END AS stage,
  'r' || min(r) FILTER (r % 4 = 0) || 'c' || min(r % 5) AS stage_ref FROM cells WHERE trim(v) <> '' GROUP BY file, r % 5""",
)
def column_remarks(r: Roles) -> DataFrame:
    c = cells(r).where("trim(v) <> ''").select("file", "r", (F.col("r") % 5).alias("c"), F.concat(F.trim("v"), F.when(F.col("r") % 4 == 0, " dry").otherwise("")).alias("v"))
    return grids.column_remarks(c, ["file"]).select("file", "c", "comments", "stage", "stage_ref")


@query(
    "n01_payload_json",
    """SELECT uuid, '{"name":' || to_json(name) || ',"method":' || coalesce(CAST(to_json(method) AS VARCHAR), 'null') || ',"candidates":[' || coalesce(CAST(to_json(uuid_analyte) AS VARCHAR), '') || '],"rl_low":' || CAST(rl_low AS VARCHAR) || '}' AS payload FROM lab_method""",
)
def payload_json(r: Roles) -> DataFrame:
    candidates = F.when(F.col("uuid_analyte").isNotNull(), F.array("uuid_analyte"))
    return r.lab_method.select("uuid", rv.payload(name=F.col("name"), method=F.col("method"), candidates=candidates, rl_low=F.col("rl_low")).alias("payload"))


@query(
    "n02_candidate_rows",
    """WITH g AS (SELECT alias_key, list(DISTINCT uuid_feature ORDER BY uuid_feature) FILTER (auto_assign AND uuid_feature IS NOT NULL) AS c, list(DISTINCT uuid_feature ORDER BY uuid_feature) FILTER (NOT auto_assign AND uuid_feature IS NOT NULL) AS e FROM feature_alias GROUP BY 1),
u AS (SELECT alias_key, list_concat(list_transform(coalesce(c, []), lambda x: {'u': x, 'k': 'candidate'}), list_transform(coalesce(e, []), lambda x: {'u': x, 'k': 'expired'})) AS l FROM g),
x AS (SELECT alias_key, unnest(l) AS s, generate_subscripts(l, 1) AS rank FROM u)
SELECT alias_key, CAST(rank AS INTEGER) AS rank, s.u AS uuid_feature, s.k AS kind FROM x""",
)
def candidate_rows(r: Roles) -> DataFrame:
    pick = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("uuid_feature"))))
    g = r.feature_alias.groupBy("alias_key").agg(pick(F.col("auto_assign")).alias("candidates"), pick(~F.col("auto_assign")).alias("expired"))
    return rv.candidate_rows(g, "alias_key")


@query("n06_payload_candidates", "SELECT event_id, CAST(n AS INTEGER) AS rank, CAST(json_extract_string(props, '$.k') AS INTEGER) + n AS candidate FROM events, (SELECT unnest([1, 2, 3]) AS n)")
def payload_candidates(r: Roles) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = r.table("events").select("event_id", F.to_json(F.struct(F.array(*[(k + i).cast("string") for i in (1, 2, 3)]).alias("candidates"))).alias("payload"))
    return rv.payload_candidates(e, "event_id").select("event_id", "rank", F.col("uuid_feature").cast("int").alias("candidate"))


@query(
    "n07_already_open",
    """SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events o WHERE o.event_type = 'error' AND o.event_id % 2 = 0 AND json_extract_string(o.props, '$.k') = json_extract_string(e.props, '$.k') AND o.user_id < 40)""",
)
def already_open(r: Roles) -> DataFrame:
    e = r.table("events")
    opened = e.where("event_type = 'error' and event_id % 2 = 0 and user_id < 40").select(F.lit("open").alias("status"), F.col("props").alias("payload"))
    return rv.already_open(e.withColumn("k", F.get_json_object("props", "$.k")), opened, "$.k", "k").select("event_id")


PAGES = r"""
f AS (SELECT page_id, 'h' || (page_id % 40) AS hash, CASE page_id % 40 % 8 WHEN 0 THEN 'a.bak' WHEN 1 THEN '.DS_Store' ELSE 'f' || (page_id % 40) || '.csv' END AS filename, CASE page_id % 40 % 8 WHEN 0 THEN 'bak' WHEN 1 THEN 'ds_store' ELSE 'csv' END AS ext, CASE WHEN page_id % 40 % 8 = 2 THEN 0 ELSE 10 END AS size FROM pages),
t AS (SELECT DISTINCT hash, filename, a.adapter, CASE WHEN a.adapter = 'x/1' AND CAST(substr(hash, 2) AS INT) % 3 = 0 THEN 'exact' WHEN a.adapter = 'y/1' AND CAST(substr(hash, 2) AS INT) % 2 = 0 THEN 'format' WHEN a.adapter = 'z/2' AND CAST(substr(hash, 2) AS INT) % 5 < 2 THEN 'format' END AS tier
  FROM f, (SELECT unnest(['x/1', 'y/1', 'z/2']) AS adapter) a)
"""


def routed(r: Roles) -> tuple[DataFrame, src.Registry]:
    k = F.col("page_id") % 40
    files = r.table("pages").select(
        "page_id", F.concat(F.lit("h"), k.cast("string")).alias("hash"), F.when(k % 8 == 0, "a.bak").when(k % 8 == 1, ".DS_Store").otherwise(F.concat(F.lit("f"), k.cast("string"), F.lit(".csv"))).alias("filename"),
        F.when(k % 8 == 0, "bak").when(k % 8 == 1, "ds_store").otherwise("csv").alias("ext"), F.when(k % 8 == 2, 0).otherwise(10).alias("size"),
    )
    reg_ = src.Registry()
    number = F.substring("hash", 2, 10).cast("int")
    reg_.register(src.Adapter("z", "2", lambda f: F.when(number % 5 < 2, "format")))
    reg_.register(src.Adapter("x", "1", lambda f: F.when(number % 3 == 0, "exact")))
    reg_.register(src.Adapter("y", "1", lambda f: F.when(number % 2 == 0, "format")))
    return files, reg_


@query("c05_router_matrix", f"WITH {PAGES} SELECT hash, filename, adapter, tier FROM t")
def router_matrix(r: Roles) -> DataFrame:
    files, registry = routed(r)
    return src.claims(files, registry).distinct()


@query(
    "c04_route_files",
    f"""WITH {PAGES}, k AS (SELECT hash, adapter, CASE tier WHEN 'exact' THEN 0 WHEN 'format' THEN 1 END AS rk FROM t WHERE tier IS NOT NULL), b AS (SELECT hash, count(*) AS n, min(adapter) AS a FROM k WHERE rk = (SELECT min(rk) FROM k x WHERE x.hash = k.hash) GROUP BY 1),
o AS (SELECT hash, min(filename) AS filename, min(ext) AS ext, min(size) AS size FROM f GROUP BY 1),
rr AS (SELECT o.*, n, a, CASE WHEN ext IN ('bak', 'tmp', 'ds_store') THEN 'ignored_extension:' || ext WHEN filename = '.DS_Store' THEN 'ds_store_file' WHEN size = 0 THEN 'empty_file' END AS ig FROM o LEFT JOIN b USING (hash))
SELECT hash, filename, CASE WHEN ig IS NOT NULL THEN 'ignored' WHEN n = 1 THEN 'claimed' ELSE 'quarantined' END AS state, coalesce(ig, CASE WHEN n IS NULL THEN 'unclaimed' WHEN n > 1 THEN 'adapter_tie' END) AS reason, CASE WHEN ig IS NULL AND n = 1 THEN a END AS adapter FROM rr""",
)
def route_files(r: Roles) -> DataFrame:
    files, registry = routed(r)
    return src.route(files, src.claims(files, registry))


STATES = ("seen", "claimed", "parsed", "assembled", "reconciled", "needs_review", "committed", "archived", "ignored", "quarantined", "failed")


@query(
    "ext_state_transitions",
    f"""WITH e AS (SELECT user_id, event_id, list_extract({list(STATES)}, CAST((event_id * 7 + user_id) % 11 + 1 AS INT)) AS st FROM events), p AS (SELECT lag(st) OVER (PARTITION BY user_id ORDER BY event_id) AS old, st AS new FROM e),
v AS (SELECT old, new, CASE WHEN old IS NULL THEN new = 'seen' ELSE coalesce((old, new) IN (('seen','claimed'),('seen','ignored'),('seen','quarantined'),('claimed','parsed'),('claimed','ignored'),('claimed','quarantined'),('parsed','assembled'),('parsed','ignored'),('assembled','reconciled'),('assembled','ignored'),('reconciled','needs_review'),('reconciled','committed'),('needs_review','committed'),('committed','archived'))
  OR (new = 'failed' AND old NOT IN ('archived', 'ignored', 'quarantined', 'failed')), FALSE) END AS valid FROM p)
SELECT old, new, valid, count(*) AS n FROM v GROUP BY ALL""",
)
def state_transitions(r: Roles) -> DataFrame:
    """Events as reports of states: each with the one before it of the same user, and whether that step is legal."""
    at = ((F.col("event_id") * 7 + F.col("user_id")) % 11).cast("int")
    new = F.get(F.array(*map(F.lit, STATES)), at)
    old = F.lag(new).over(Window.partitionBy("user_id").orderBy("event_id"))
    steps = r.table("events").select(old.alias("old"), new.alias("new"))
    return steps.groupBy("old", "new", store.valid_transition(F.col("old"), F.col("new")).alias("valid")).agg(F.count("*").alias("n"))


@query("b06_upsert", "SELECT uuid, CASE WHEN revision > 5 THEN value * 2 ELSE value END AS value FROM analysis UNION ALL SELECT 'new' || o_orderkey, o_totalprice FROM orders")
def upsert(r: Roles) -> DataFrame:
    new = r.analysis.where("revision > 5").select("uuid", (F.col("value") * 2).alias("value"))
    extra = r.table("orders").select(F.concat(F.lit("new"), F.col("o_orderkey").cast("string")).alias("uuid"), F.col("o_totalprice").alias("value"))
    return store.upserted(r.analysis.select("uuid", "value"), new.unionByName(extra))


@query(
    "e25_table_checksum",
    """SELECT count(*) AS n, CAST(sum(h) AS BIGINT) AS total, bit_xor(h) AS mix FROM (SELECT CAST('0x' || substr(md5(concat_ws('|', uuid, uuid_sample, uuid_lab, coalesce(value_chr, '?'), coalesce(CAST(quantified AS VARCHAR), '?'), CAST(revision AS VARCHAR))), 1, 8) AS BIGINT) AS h FROM analysis)""",
)
def table_checksum(r: Roles) -> DataFrame:
    return reg.checksum(r.analysis.select("uuid", "uuid_sample", "uuid_lab", "value_chr", "quantified", "revision"))


@query("ext_event_windows", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(r: Roles) -> DataFrame:
    """An extension: the streaming module's tumbling windows, here over the whole table at once."""
    from ..streaming.ingest import windowed_counts

    e = r.table("events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    w = windowed_counts(e)
    return w.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))
