"""Queries of commits, confirmations, guards and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, values
from ..operators import commit as cm
from ..operators import grids, joins
from ..operators import reconcile as rc
from ..operators import registry as reg
from ..operators import resolve as rs
from ..operators import reviews as rv
from ..sources import files as src
from ..warehouse import store
from .registry import query
from .roles import Roles

DAY = "CAST(s.datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE)"


@query(
    "e19_materialise_aliases",
    """WITH p AS (SELECT lower(p_name) || ' ' || (l_partkey % 90) AS alias_key, CAST(l_shipdate AS DATE) AS date, l_orderkey % 5 AS h FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT alias_key, count(DISTINCT (date, h)) AS n, min(date) AS d FROM p GROUP BY 1), o AS (SELECT alias_key, min(uuid) AS uuid, arg_min(k, uuid) AS k FROM (SELECT *, CAST(substr(uuid, 4) AS BIGINT) % 2 AS k FROM feature_alias WHERE uuid_feature IS NULL) GROUP BY 1)
SELECT alias_key, coalesce(o.uuid, 'new') AS uuid, n + CASE WHEN o.uuid IS NULL THEN 0 ELSE 3 END AS n_seen, CASE WHEN o.uuid IS NULL THEN CAST(d AS VARCHAR) WHEN k = 1 THEN '1997-01-01' END AS date_start, o.uuid IS NULL AS is_new FROM g LEFT JOIN o USING (alias_key)""",
)
def materialise_aliases(r: Roles) -> DataFrame:
    part = r.table("part").select("p_partkey", "p_name")
    rows = r.table("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.concat(F.lower("p_name"), F.lit(" "), (F.col("l_partkey") % 90).cast("string")).alias("alias_key"), F.to_date("l_shipdate").alias("date"), (F.col("l_orderkey") % 5).alias("datetime"))
    bound = F.when(F.substring("uuid", 4, 20).cast("long") % 2 == 1, F.lit("1997-01-01")).cast("date")  # some stored aliases have one, some hold without
    out = cm.materialise_aliases(rows, r.feature_alias.withColumn("n_seen", F.lit(3)).withColumn("date_start", bound))
    return out.select("alias_key", F.when(F.col("is_new"), "new").otherwise(F.col("uuid")).alias("uuid"), "n_seen", F.col("date_start").cast("string").alias("date_start"), "is_new")


@query(
    "e20_materialise_methods",
    r"""WITH a AS (SELECT organisation AS org, nullif(lower(regexp_replace(name || CASE WHEN rl_low > 40 THEN ' x' ELSE '' END, '[^A-Za-z0-9]', '', 'g')), '') AS nk, nullif(lower(regexp_replace(method, '[^A-Za-z0-9]', '', 'g')), '') AS mk, 'mg/L' AS units FROM lab_method),
g AS (SELECT org, nk, mk, min(units) AS units, count(*) AS n_rows FROM a GROUP BY 1, 2, 3),
o AS (SELECT organisation AS org, nullif(lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')), '') AS nk, nullif(lower(regexp_replace(method, '[^A-Za-z0-9]', '', 'g')), '') AS mk, min(uuid) AS uuid, arg_min(coalesce(units, '?'), uuid) AS ou FROM lab_method WHERE uuid_analyte IS NULL GROUP BY 1, 2, 3)
SELECT g.org, g.nk AS name_key, g.mk AS meth_key, n_rows, o.uuid, o.uuid IS NULL AS is_new, o.uuid IS NOT NULL AND g.units <> ou AS drifted FROM g LEFT JOIN o ON g.org = o.org AND g.nk = o.nk AND g.mk IS NOT DISTINCT FROM o.mk""",
)
def materialise_methods(r: Roles) -> DataFrame:
    name = F.concat("name", F.when(F.col("rl_low") > 40, " x").otherwise(""))
    rows = r.lab_method.select(F.col("organisation").alias("org"), name.alias("analyte_raw"), F.col("method").alias("method_raw"), F.lit("mg/L").alias("units"))
    return cm.materialise_methods(rows, r.lab_method)


@query(
    "e17_recorded_revisions",
    """WITH b AS (SELECT 'WO' || (o_orderkey % 300) AS wo, 'h' || (o_orderkey % 700) AS hash, o_orderkey % 6 AS rev FROM orders UNION ALL SELECT 'WO' || (c_custkey % 350), 'h' || (c_custkey % 800), c_custkey % 9 FROM customer)
SELECT wo AS work_order, max(rev) AS revision FROM b WHERE hash NOT IN (SELECT 'h' || (p_partkey * 3) FROM part) GROUP BY 1""",
)
def recorded_revisions(r: Roles) -> DataFrame:
    def rows(table: str, key: str, a: int, b: int, c: int) -> DataFrame:
        k = F.col(key)
        return r.table(table).select(F.concat(F.lit("WO"), (k % a).cast("string")).alias("work_order"), F.concat(F.lit("h"), (k % b).cast("string")).alias("hash"), (k % c).alias("revision"))

    own = r.table("part").select(F.concat(F.lit("h"), (F.col("p_partkey") * 3).cast("string")).alias("hash"))
    return cm.recorded_revisions(rows("orders", "o_orderkey", 300, 700, 6), rows("customer", "c_custkey", 350, 800, 9), own)


@query(
    "p11_reingest_guard",
    """WITH w AS (SELECT o_custkey AS work_order, count(*) FILTER (o_orderstatus = 'F') AS n_samples, count(*) FILTER (o_orderkey % 3 = 0) AS n_prior, max(o_orderkey % 4) AS inc, CASE WHEN o_custkey % 5 <> 0 THEN min(o_orderkey % 7) END AS rec, count(*) FILTER (o_orderpriority = '5-LOW') AS unm FROM orders GROUP BY 1)
SELECT work_order, CASE WHEN n_samples = 0 OR n_prior = 0 THEN 'new' WHEN inc > rec THEN 'higher_revision' WHEN unm = 0 THEN 'all_match' ELSE 'blocked' END AS decision FROM w""",
)
def reingest_guard(r: Roles) -> DataFrame:
    k = F.col("o_orderkey")
    w = r.table("orders").groupBy(F.col("o_custkey").alias("work_order")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n_samples"), F.count_if(k % 3 == 0).alias("n_prior_assets"), F.max(k % 4).alias("incoming_revision"),
        F.min(k % 7).alias("_rec"), F.count_if(F.col("o_orderpriority") == "5-LOW").alias("n_unmatched"),
    )
    w = w.withColumn("recorded_revision", F.when(F.col("work_order") % 5 != 0, F.col("_rec")))
    return cm.reingest_guard(w).select("work_order", "decision")


PROJECTS = """
project AS (SELECT 'c' || r_regionkey AS uuid, r_name AS name, CAST(NULL AS VARCHAR) AS uuid_parent, CAST(NULL AS VARCHAR) AS uuid_root FROM region
  UNION ALL SELECT 'r' || n_nationkey, n_name, CASE WHEN n_nationkey % 4 <> 0 THEN 'c' || n_regionkey END, CASE WHEN n_nationkey % 3 = 0 THEN 'c' || n_regionkey END FROM nation
  UNION ALL SELECT 'w' || c_custkey, c_name, CASE WHEN c_custkey % 6 <> 0 THEN 'c' || (c_nationkey % 5) END, NULL FROM customer)
"""


def projects(r: Roles) -> DataFrame:
    none = F.lit(None).cast("string")
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    top = r.table("region").select(k("c", "r_regionkey").alias("uuid"), F.col("r_name").alias("name"), none.alias("uuid_parent"), none.alias("uuid_root"))
    mid = r.table("nation").select(
        k("r", "n_nationkey"), "n_name", F.when(F.col("n_nationkey") % 4 != 0, k("c", "n_regionkey")), F.when(F.col("n_nationkey") % 3 == 0, k("c", "n_regionkey"))
    )
    low = r.table("customer").select(k("w", "c_custkey"), "c_name", F.when(F.col("c_custkey") % 6 != 0, F.concat(F.lit("c"), (F.col("c_nationkey") % 5).cast("string"))), none)
    return top.union(mid).union(low)


@query("p21_project_roots", f"WITH {PROJECTS} SELECT uuid, coalesce(uuid_root, uuid_parent, uuid) AS root_of FROM project")
def project_roots(r: Roles) -> DataFrame:
    return cm.project_roots(projects(r)).select("uuid", "root_of")


@query("p20_project_tree", f"WITH {PROJECTS} SELECT a.uuid, a.name, b.name AS parent, c.name AS grandparent FROM project a LEFT JOIN project b ON a.uuid_parent = b.uuid LEFT JOIN project c ON b.uuid_parent = c.uuid")
def project_tree(r: Roles) -> DataFrame:
    return cm.project_chains(projects(r))


@query(
    "p19_report_parents",
    f"""WITH {PROJECTS}, kids AS (SELECT n_name AS report, c_name AS work_order FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 5 = c_nationkey % 5),
g AS (SELECT report, count(DISTINCT w.uuid_parent) AS n, min(w.uuid_parent) AS up FROM kids LEFT JOIN project w ON w.name = kids.work_order GROUP BY 1)
SELECT g.report, coalesce(p.uuid_parent, CASE WHEN n = 1 THEN up END) AS uuid_parent, CASE WHEN n = 0 THEN 'none' WHEN n > 1 THEN 'ambiguous' WHEN p.uuid_parent IS NULL THEN 'adopted' WHEN p.uuid_parent = up THEN 'kept' ELSE 'project_parent_conflict' END AS status
FROM g LEFT JOIN project p ON p.name = g.report""",
)
def report_parents(r: Roles) -> DataFrame:
    n = r.table("nation").select("n_nationkey", "n_name")
    kids = r.table("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).where("c_custkey % 5 = c_nationkey % 5")
    return cm.adopted_parents(kids.select(F.col("n_name").alias("report"), F.col("c_name").alias("work_order")), projects(r))


@query("p17_resolution_provenance", "SELECT uuid_sample, uuid_alias, CASE WHEN organisation = 'ALS' THEN 'structural' ELSE 'site_inferred' END AS resolution, count(*) AS n_rows FROM incoming WHERE method IS NOT NULL GROUP BY 1, 2, 3")
def resolution_provenance(r: Roles) -> DataFrame:
    res = F.when(F.col("method").isNotNull(), F.when(F.col("organisation") == "ALS", "structural").otherwise("site_inferred"))
    return cm.resolution_provenance(r.incoming.withColumn("resolution", res))


@query("p15_delete_superseded", "SELECT uuid, value FROM analysis WHERE uuid IN (SELECT replace(source_ref, 'x1', 'x2') FROM incoming WHERE organisation = 'ACIRL')")
def delete_superseded(r: Roles) -> DataFrame:
    gone = r.incoming.where("organisation = 'ACIRL'").select(F.replace("source_ref", F.lit("x1"), F.lit("x2")).alias("uuid_analysis"))
    return cm.deletions(gone, r.analysis).select("uuid", "value")


@query(
    "p16_already_present_log",
    """SELECT i.uuid_sample AS uuid_row, count(*) AS n, min(i.source_ref) AS least FROM incoming i JOIN stored e ON e.uuid = i.source_ref AND i.value IS NOT DISTINCT FROM e.value GROUP BY 1""",
)
def already_present_log(r: Roles) -> DataFrame:
    e = r.stored.select(F.col("uuid").alias("e_uuid"), F.col("value").alias("e_value"))
    same = r.incoming.join(e, F.col("source_ref") == F.col("e_uuid")).where(F.col("value").eqNullSafe(F.col("e_value")))
    return same.groupBy(F.col("uuid_sample").alias("uuid_row")).agg(F.count("*").alias("n"), F.min("source_ref").alias("least"))


@query(
    "p22_confirm_aliases",
    """WITH q AS (SELECT fa.uuid AS ua, coalesce(fa.uuid_feature, 'f' || (length(fa.alias_key) * 7 % 130)) AS uf, length(fa.uuid) % 2 = 0 AS ov, fa.date_start AS ds, fa.date_end AS de FROM feature_alias fa
  UNION ALL SELECT 'fas' || substr(uuid, 2), uuid, FALSE, NULL, NULL FROM feature UNION ALL SELECT 'fap1', uuid, length(name) % 2 = 0, NULL, NULL FROM feature),
hit AS (SELECT DISTINCT 'fap1' AS ua, uuid AS uf FROM feature WHERE date_end IS NOT NULL), own AS (SELECT uuid_feature, min(uuid) AS o FROM feature_alias WHERE kind = 'self' GROUP BY 1)
SELECT ua AS uuid_alias, uf AS uuid_feature, CASE WHEN a.uuid IS NULL OR f.uuid IS NULL THEN 'unknown' WHEN a.uuid_feature = uf AND (ds IS NOT NULL OR de IS NOT NULL) THEN 'bounds_updated' WHEN a.uuid_feature = uf THEN 'confirmed'
  WHEN hit.ua IS NOT NULL AND NOT ov THEN 'collision' WHEN a.alias_key = lower(f.name) AND own.o IS NOT NULL THEN 'merged' WHEN a.alias_key = lower(f.name) THEN 'self_arm' ELSE 'confirmed' END AS action
FROM q LEFT JOIN feature_alias a ON a.uuid = ua LEFT JOIN feature f ON f.uuid = uf LEFT JOIN hit USING (ua, uf) LEFT JOIN own ON own.uuid_feature = uf""",
)
def confirm_aliases(r: Roles) -> DataFrame:
    fa, f = r.feature_alias, r.feature
    none = F.lit(None).cast("date")
    q = fa.select(
        F.col("uuid").alias("uuid_alias"), F.coalesce("uuid_feature", F.concat(F.lit("f"), (F.length("alias_key") * 7 % 130).cast("string"))).alias("uuid_feature"),
        (F.length("uuid") % 2 == 0).alias("override"), "date_start", "date_end",
    )
    q = q.union(f.select(F.concat(F.lit("fas"), F.substring("uuid", 2, 20)), "uuid", F.lit(False), none, none))
    q = q.union(f.select(F.lit("fap1"), "uuid", F.length("name") % 2 == 0, none, none))
    hit = f.where("date_end is not null").select(F.lit("fap1").alias("uuid_alias"), F.col("uuid").alias("uuid_feature"))
    return cm.confirm_aliases(q, fa, f, hit)


@query(
    "p29_confirm_methods",
    """WITH q AS (SELECT uuid AS ul, 'a' || name AS ua FROM lab_method UNION ALL SELECT uuid || 'x', 'aX' FROM lab_method UNION ALL SELECT uuid, 'aSMALL' FROM lab_method),
rec AS (SELECT uuid AS ul, units FROM lab_method UNION ALL SELECT uuid, 'mg/L' FROM lab_method WHERE rl_low > 25), n AS (SELECT ul, count(DISTINCT units) AS n FROM rec WHERE units IS NOT NULL GROUP BY 1)
SELECT q.ul AS uuid_lab, q.ua AS uuid_analyte, CASE WHEN m.uuid IS NULL THEN 'unknown' WHEN m.uuid_analyte = q.ua THEN 'already_confirmed' WHEN m.uuid_analyte IS NOT NULL THEN 'repoint_refused' WHEN n.n > 1 THEN 'units_drift' ELSE 'confirmed' END AS status
FROM q LEFT JOIN lab_method m ON m.uuid = q.ul LEFT JOIN n ON n.ul = q.ul""",
)
def confirm_methods(r: Roles) -> DataFrame:
    m = r.lab_method
    q = m.select(F.col("uuid").alias("uuid_lab"), F.concat(F.lit("a"), "name").alias("uuid_analyte"))
    q = q.union(m.select(F.concat("uuid", F.lit("x")), F.lit("aX"))).union(m.select("uuid", F.lit("aSMALL")))
    rec = m.select(F.col("uuid").alias("uuid_lab"), "units").union(m.where("rl_low > 25").select("uuid", F.lit("mg/L")))
    return cm.confirm_methods(q, m, rec)


@query("p25_repoint", "SELECT s.uuid, coalesce(m.new, s.uuid_feature_alias) AS uuid_feature_alias FROM sample s LEFT JOIN (SELECT uuid AS old, 'fas' || substr(uuid_feature, 2) AS new FROM feature_alias WHERE kind <> 'self' AND uuid_feature IS NOT NULL) m ON s.uuid_feature_alias = m.old")
def repoint(r: Roles) -> DataFrame:
    moves = r.feature_alias.where("kind <> 'self' and uuid_feature is not null").select(F.col("uuid").alias("old"), F.concat(F.lit("fas"), F.substring("uuid_feature", 2, 20)).alias("new"))
    return cm.repointed(r.sample, "uuid_feature_alias", moves).select("uuid", "uuid_feature_alias")


@query(
    "p28_merge_identity_aliases",
    """WITH fb AS (SELECT uuid, uuid_feature, alias_key, kind FROM feature_alias UNION ALL SELECT 'dup' || uuid, uuid, lower(name), 'historical_code' FROM feature WHERE date_end IS NOT NULL),
sm AS (SELECT uuid, CASE WHEN length(uuid) % 2 = 0 THEN replace(uuid_feature_alias, 'fas', 'dupf') ELSE uuid_feature_alias END AS fa FROM sample),
d AS (SELECT s.uuid AS keep, o.uuid AS gone FROM fb s JOIN fb o ON s.uuid_feature = o.uuid_feature AND s.alias_key = o.alias_key JOIN feature f ON f.uuid = s.uuid_feature AND lower(f.name) = s.alias_key WHERE s.kind = 'self' AND o.kind <> 'self')
SELECT keep, gone, count(sm.uuid) AS n_repointed FROM d LEFT JOIN sm ON sm.fa = d.gone GROUP BY 1, 2""",
)
def merge_identity_aliases(r: Roles) -> DataFrame:
    f = r.feature.where("date_end is not null").select(F.concat(F.lit("dup"), "uuid").alias("uuid"), F.col("uuid").alias("uuid_feature"), F.lower("name").alias("alias_key"), F.lit("historical_code").alias("kind"))
    fb = r.feature_alias.select("uuid", "uuid_feature", "alias_key", "kind").unionByName(f)
    sm = r.sample.select(F.col("uuid").alias("s"), F.when(F.length("uuid") % 2 == 0, F.replace("uuid_feature_alias", F.lit("fas"), F.lit("dupf"))).otherwise(F.col("uuid_feature_alias")).alias("fa"))
    d = reg.identity_duplicates(fb, r.feature)
    return d.join(sm, F.col("fa") == F.col("uuid_other"), "left").groupBy(F.col("uuid_self").alias("keep"), F.col("uuid_other").alias("gone")).agg(F.count("s").alias("n_repointed"))


LOG = "SELECT CASE WHEN l_linenumber < 4 THEN 'sample' ELSE 'analysis' END AS tbl, 'field' || (l_partkey % 40) AS field, CASE l_returnflag WHEN 'R' THEN 'reattach:' || l_linenumber WHEN 'A' THEN 'detach' ELSE 'other' END AS reason FROM lineitem"


@query("e11_torn_updates", f"WITH l AS ({LOG}) SELECT tbl, field, count(*) FILTER (reason LIKE 'detach%') AS n_detached, count(*) FILTER (reason LIKE 'reattach%') AS n_attached FROM l GROUP BY 1, 2 HAVING count(*) FILTER (reason LIKE 'detach%') > count(*) FILTER (reason LIKE 'reattach%')")
def torn_updates(r: Roles) -> DataFrame:
    flag = F.col("l_returnflag")
    log = r.table("lineitem").select(
        F.when(F.col("l_linenumber") < 4, "sample").otherwise("analysis").alias("tbl"), F.concat(F.lit("field"), (F.col("l_partkey") % 40).cast("string")).alias("field"),
        F.when(flag == "R", F.concat(F.lit("reattach:"), F.col("l_linenumber").cast("string"))).when(flag == "A", "detach").otherwise("other").alias("reason"),
    )
    return cm.torn_updates(log)


@query(
    "p42_mapping_faults",
    r"""WITH m AS (SELECT CASE p_partkey % 20 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN ' ' || p_name ELSE p_name || '-' || (p_partkey % 50) END AS name, 'a' || p_type AS ua, p_size - 2 AS c FROM part),
k AS (SELECT *, nullif(lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')), '') AS fold FROM m)
SELECT 'blank_name' AS fault, count(*) FILTER (coalesce(trim(name) = '', TRUE)) AS n FROM m UNION ALL SELECT 'untrimmed_name', count(*) FILTER (name <> trim(name)) FROM m UNION ALL SELECT 'bad_constant', count(*) FILTER (c <= 0) FROM m
UNION ALL SELECT 'duplicate_name', count(*) FROM (SELECT name FROM m GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'fold_of_several_analytes', count(*) FROM (SELECT fold FROM k WHERE fold IS NOT NULL GROUP BY 1 HAVING count(DISTINCT ua) > 1)""",
)
def mapping_faults(r: Roles) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(k % 20 == 0, "").when(k % 20 == 2, F.concat(F.lit(" "), "p_name")).when(k % 20 != 1, F.concat("p_name", F.lit("-"), (k % 50).cast("string")))
    m = r.table("part").select(name.alias("name"), F.concat(F.lit("a"), "p_type").alias("uuid_analyte"), (F.col("p_size") - 2).alias("constant"))
    return cm.mapping_faults(m)


@query(
    "p06_cas_suggestions",
    """WITH an AS (SELECT 'a' || p_partkey AS uuid, CASE WHEN p_size % 3 <> 0 THEN (p_partkey % 500) || '-00-' || (p_size % 4) END AS cas FROM part),
m AS (SELECT l_orderkey || '.' || l_linenumber || '.' || l_partkey AS row, CASE WHEN l_linenumber <> 4 THEN (l_partkey % 600) || '-00-' || (l_linenumber % 4) END AS cas FROM lineitem)
SELECT row, (SELECT min(uuid) FROM an WHERE an.cas = m.cas) AS suggested FROM m WHERE m.cas IN (SELECT cas FROM an WHERE cas IS NOT NULL)""",
)
def cas_suggestions(r: Roles) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    cas = lambda a, b: F.concat(a.cast("string"), F.lit("-00-"), b.cast("string"))
    an = r.table("part").select(F.concat(F.lit("a"), s("p_partkey")).alias("uuid"), F.when(F.col("p_size") % 3 != 0, cas(F.col("p_partkey") % 500, F.col("p_size") % 4)).alias("cas"))
    m = r.table("lineitem").select(
        F.concat_ws(".", s("l_orderkey"), s("l_linenumber"), s("l_partkey")).alias("row"), F.when(F.col("l_linenumber") != 4, cas(F.col("l_partkey") % 600, F.col("l_linenumber") % 4)).alias("cas_number")
    )
    return cm.cas_suggestions(m, an)


@query(
    "l09_manual_corrections",
    """WITH c AS (SELECT uuid, value + 1 AS nv FROM analysis WHERE revision = 7 OR revision = 1)
SELECT a.uuid, CASE WHEN c.uuid IS NOT NULL AND nv IS NOT NULL AND value_chr IS NOT NULL THEN 'refused' WHEN nv IS NOT NULL THEN 'corrected' ELSE 'unchanged' END AS status,
  CASE WHEN nv IS NOT NULL AND value_chr IS NULL THEN nv ELSE value END AS value, CASE WHEN nv IS NOT NULL AND value_chr IS NULL THEN NOT coalesce(nv <= rl_low, FALSE) ELSE quantified END AS quantified FROM analysis a LEFT JOIN c USING (uuid)""",
)
def manual_corrections(r: Roles) -> DataFrame:
    c = r.analysis.where("revision = 7 or revision = 1").select("uuid", (F.col("value") + 1).alias("new_value"))
    return cm.corrected(r.analysis, c).select("uuid", "status", "value", "quantified")


@query(
    "p44_check_battery",
    f"""WITH c AS (SELECT 'alias_without_feature' AS name, count(*) AS n_bad FROM feature_alias WHERE uuid_feature IS NOT NULL AND uuid_feature NOT IN (SELECT uuid FROM feature)
UNION ALL SELECT 'feature_without_self', count(*) FROM feature WHERE uuid NOT IN (SELECT uuid_feature FROM feature_alias WHERE kind = 'self' AND uuid_feature IS NOT NULL)
UNION ALL SELECT 'sample_without_alias', count(*) FROM sample WHERE uuid_feature_alias NOT IN (SELECT uuid FROM feature_alias) UNION ALL SELECT 'analysis_without_method', count(*) FROM analysis WHERE uuid_lab NOT IN (SELECT uuid FROM lab_method)
UNION ALL SELECT 'duplicate_analysis', count(*) FROM (SELECT uuid FROM analysis GROUP BY 1 HAVING count(*) > 1)) SELECT name, n_bad, n_bad = 0 AS passed FROM c""",
)
def check_battery(r: Roles) -> DataFrame:
    anti = lambda a, col, b, key: a.where(F.col(col).isNotNull()).join(b.select(F.col(key).alias(col)), col, "left_anti")
    return cm.checks(
        {
            "alias_without_feature": anti(r.feature_alias, "uuid_feature", r.feature, "uuid"),
            "feature_without_self": reg.without_self(r.feature, r.feature_alias),
            "sample_without_alias": anti(r.sample, "uuid_feature_alias", r.feature_alias, "uuid"),
            "analysis_without_method": anti(r.analysis, "uuid_lab", r.lab_method, "uuid"),
            "duplicate_analysis": reg.violations(r.analysis, ["uuid"]),
        }
    )


@query(
    "c21_validate_table",
    """SELECT rule, n FROM (SELECT 'null:value' AS rule, count(*) FILTER (value IS NULL) AS n FROM analysis UNION ALL SELECT 'null:uuid', 0 FROM (SELECT 1) UNION ALL SELECT 'vocabulary:value_chr', count(*) FILTER (value_chr NOT IN ('Wet')) FROM analysis
UNION ALL SELECT 'negative:revision', count(*) FILTER (revision - 3 < 0) FROM analysis)""",
)
def validate_table(r: Roles) -> DataFrame:
    return cm.validate(r.analysis.withColumn("revision", F.col("revision") - 3), ["value", "uuid"], {"value_chr": ("Wet",)}, ["revision"])


@query(
    "d12_existing_pending",
    """WITH d AS (SELECT alias_key, min(uuid) AS uuid FROM feature_alias WHERE uuid_feature IS NULL GROUP BY 1) SELECT p_partkey, d.uuid AS uuid_alias FROM part LEFT JOIN d ON d.alias_key = lower(p_name) || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' ' || p_partkey END""",
)
def existing_pending(r: Roles) -> DataFrame:
    d = joins.first_by(r.feature_alias.where("uuid_feature is null"), ["alias_key"], [F.col("uuid")]).select("alias_key", F.col("uuid").alias("uuid_alias"))
    k = F.col("p_partkey")
    key = F.concat(F.lower("p_name"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit(" "), k.cast("string"))))
    return r.table("part").select("p_partkey", key.alias("alias_key")).join(d, "alias_key", "left").select("p_partkey", "uuid_alias")


@query("d19_prior_assets", "SELECT DISTINCT 'WO' || (o_custkey % 50) AS work_order, 'h' || (o_orderkey % 900) AS hash FROM orders WHERE 'h' || (o_orderkey % 900) NOT IN (SELECT 'h' || c_custkey FROM customer WHERE c_acctbal < 0)")
def prior_assets(r: Roles) -> DataFrame:
    a = r.table("orders").select(F.concat(F.lit("WO"), (F.col("o_custkey") % 50).cast("string")).alias("work_order"), F.concat(F.lit("h"), (F.col("o_orderkey") % 900).cast("string")).alias("hash"))
    own = r.table("customer").where("c_acctbal < 0").select(F.concat(F.lit("h"), F.col("c_custkey").cast("string")).alias("hash"))
    return a.join(own, "hash", "left_anti").select("work_order", "hash").distinct()


@query(
    "d17_row_feature_keys",
    """SELECT s.uuid, fa.uuid_feature IS NULL AS pending, coalesce(own.uuid, fa.uuid) AS uuid_alias FROM sample s JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid LEFT JOIN (SELECT uuid_feature, min(uuid) AS uuid FROM feature_alias WHERE kind = 'self' GROUP BY 1) own ON own.uuid_feature = fa.uuid_feature""",
)
def row_feature_keys(r: Roles) -> DataFrame:
    fa = joins.prefixed(r.feature_alias.select("uuid", "uuid_feature"), "a_")
    own = r.feature_alias.where("kind = 'self' and uuid_feature is not null").groupBy(F.col("uuid_feature").alias("o_f")).agg(F.min("uuid").alias("o_uuid"))
    rows = r.sample.join(fa, F.col("uuid_feature_alias") == F.col("a_uuid")).join(own, F.col("a_uuid_feature") == F.col("o_f"), "left")
    return rows.select("uuid", F.col("a_uuid_feature").isNull().alias("pending"), F.coalesce("o_uuid", "a_uuid").alias("uuid_alias"))


@query(
    "d25_duplicate_pairs",
    f"""WITH x AS (SELECT s.uuid, fa.uuid_feature AS f, {DAY} AS day, (SELECT count(*) FROM analysis a WHERE a.uuid_sample = s.uuid) AS n FROM sample s JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid WHERE fa.uuid_feature IS NOT NULL AND s.datetime IS NOT NULL)
SELECT a.uuid AS a, b.uuid AS b, a.n AS n_a, b.n AS n_b FROM x a JOIN x b ON a.f = b.f AND a.day = b.day AND a.uuid < b.uuid""",
)
def duplicate_pairs(r: Roles) -> DataFrame:
    n = r.analysis.groupBy(F.col("uuid_sample").alias("ns")).agg(F.count("*").alias("n"))
    fa = joins.prefixed(r.feature_alias.where("uuid_feature is not null").select("uuid", "uuid_feature"), "a_")
    x = r.sample.where("datetime is not null").join(fa, F.col("uuid_feature_alias") == F.col("a_uuid")).join(n, F.col("uuid") == F.col("ns"), "left")
    x = x.select("uuid", F.col("a_uuid_feature").alias("f"), dates.civil_date(F.col("datetime")).alias("day"), F.coalesce("n", F.lit(0)).alias("n"))
    y = x.select(F.col("uuid").alias("b"), F.col("f").alias("f2"), F.col("day").alias("day2"), F.col("n").alias("n_b"))
    return x.join(y, (F.col("f") == F.col("f2")) & (F.col("day") == F.col("day2")) & (F.col("uuid") < F.col("b"))).select(F.col("uuid").alias("a"), "b", F.col("n").alias("n_a"), "n_b")


@query("f09_event_site", "SELECT o_orderkey % 600 AS event, CASE WHEN count(DISTINCT f.site) = 1 AND bool_and(f.site IS NOT NULL) THEN min(f.site) END AS site FROM orders LEFT JOIN feature f ON f.uuid = 'f' || (o_custkey % 20) AND o_orderkey % 2 = 0 GROUP BY 1")
def event_site(r: Roles) -> DataFrame:
    f = r.feature.select("uuid", "site")
    o = r.table("orders").select((F.col("o_orderkey") % 600).alias("event"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("f"), (F.col("o_custkey") % 20).cast("string"))).alias("u"))
    g = o.join(f, F.col("u") == F.col("uuid"), "left").groupBy("event").agg(F.collect_set("site").alias("s"), F.bool_and(F.col("site").isNotNull()).alias("all"))
    return g.select("event", F.when(F.col("all") & (F.size("s") == 1), F.col("s")[0]).alias("site"))


@query("f16_keep_first", "SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def keep_first(r: Roles) -> DataFrame:
    return joins.first_by(r.table("orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("h02_union_by_name", "SELECT 'feature' AS kind, uuid, site, CAST(NULL AS VARCHAR) AS units FROM feature UNION ALL SELECT 'method', uuid, NULL, units FROM lab_method")
def union_by_name(r: Roles) -> DataFrame:
    a = r.feature.select(F.lit("feature").alias("kind"), "uuid", "site")
    b = r.lab_method.select(F.lit("method").alias("kind"), "uuid", "units")
    return a.unionByName(b, allowMissingColumns=True)


@query("h03_fill_missing_columns", "SELECT uuid, CAST(NULL AS VARCHAR) AS review_kind, CAST(NULL AS DOUBLE) AS confidence FROM lab_method")
def fill_missing_columns(r: Roles) -> DataFrame:
    return cm.missing_columns(r.lab_method.select("uuid"), {"uuid": "string", "review_kind": "string", "confidence": "double"})


@query("e14_constant_duplicates", "SELECT a.uuid, (SELECT count(*) FROM lab_method m WHERE m.uuid_analyte = a.uuid AND m.conversion_constant IS NOT NULL) AS n FROM analyte a")
def constant_duplicates(r: Roles) -> DataFrame:
    n = r.lab_method.where("conversion_constant is not null").groupBy(F.col("uuid_analyte").alias("a")).agg(F.count("*").alias("n"))
    return r.analyte.select("uuid").join(n, F.col("uuid") == F.col("a"), "left").select("uuid", F.coalesce("n", F.lit(0)).alias("n"))


@query("e33_cited_reports", r"SELECT conv_id, list_aggregate(list_sort(list_distinct(flatten(list(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{9,}'))))), 'string_agg', ',') AS words FROM conversations GROUP BY 1 HAVING len(flatten(list(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{9,}')))) > 0")
def cited_words(r: Roles) -> DataFrame:
    """Sorted distinct union of arrays: here of the long words of a conversation."""
    each = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([A-Za-z]{9,})"), F.lit(1))
    g = r.table("conversations").groupBy("conv_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(each)))).alias("w"))
    return g.where("size(w) > 0").select("conv_id", F.array_join("w", ",").alias("words"))


@query("e35_own_hashes", "SELECT 'h' || (o_orderkey % 700) AS hash FROM orders UNION SELECT 'h' || (c_custkey % 900) FROM customer UNION SELECT 'h' || (p_partkey * 2) FROM part")
def own_hashes(r: Roles) -> DataFrame:
    h = lambda t, c: r.table(t).select(F.concat(F.lit("h"), c.cast("string")).alias("hash"))
    return h("orders", F.col("o_orderkey") % 700).union(h("customer", F.col("c_custkey") % 900)).union(h("part", F.col("p_partkey") * 2)).distinct()


@query("e22_batch_report", "SELECT CASE o_orderstatus WHEN 'F' THEN 'committed' WHEN 'O' THEN 'needs_review' ELSE 'ignored' END AS state, count(*) AS n FROM orders GROUP BY 1")
def batch_report(r: Roles) -> DataFrame:
    s = F.col("o_orderstatus")
    return rc.counts(r.table("orders").withColumn("state", F.when(s == "F", "committed").when(s == "O", "needs_review").otherwise("ignored")), "state")


@query(
    "n09_spread_references",
    """WITH rv AS (SELECT o_custkey AS uuid, 'h' || (o_custkey % 7) AS h, string_agg('r' || o_orderkey, ',' ORDER BY o_orderkey) AS refs FROM orders GROUP BY 1, 2), x AS (SELECT uuid, h, unnest(string_split(refs, ',')) AS ref, generate_subscripts(string_split(refs, ','), 1) AS p FROM rv),
cl AS (SELECT 'h' || (o_custkey % 7) AS h, 'r' || o_orderkey AS ref, 'fa' || o_orderkey AS fa FROM orders WHERE o_orderkey % 3 = 0)
SELECT uuid, arg_min(fa, p) AS uuid_alias FROM x JOIN cl USING (h, ref) GROUP BY 1""",
)
def spread_references(r: Roles) -> DataFrame:
    o = r.table("orders")
    h = F.concat(F.lit("h"), (F.col("o_custkey") % 7).cast("string"))
    refs = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.concat(F.lit("r"), k.cast("string"))), ",")
    reviews = o.groupBy(F.col("o_custkey").alias("uuid"), h.alias("source_hash")).agg(refs.alias("source_ref"))
    s = F.col("o_orderkey").cast("string")
    clean = o.where("o_orderkey % 3 = 0").select(h.alias("source_hash"), F.concat(F.lit("r"), s).alias("source_ref"), F.concat(F.lit("fa"), s).alias("uuid_alias"))
    return rv.spread_references(reviews, clean, "uuid")


@query("n10_shadowed_groups", "SELECT alias_key, string_agg(DISTINCT uuid_feature, ',' ORDER BY uuid_feature) AS shadowed FROM feature_alias WHERE uuid_feature IS NOT NULL AND kind <> 'self' GROUP BY 1")
def shadowed_groups(r: Roles) -> DataFrame:
    g = r.feature_alias.where("uuid_feature is not null and kind <> 'self'").groupBy("alias_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("uuid_feature"))))).alias("s"))
    return g.select("alias_key", F.array_join("s", ",").alias("shadowed"))


@query(
    "i09_dust_results",
    """WITH d AS (SELECT 'u' || user_id AS gauge, event_id % 9 AS block, event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) END AS month_date FROM events WHERE event_type = 'click'),
o AS (SELECT 'u' || user_id AS gauge, event_id % 9 AS block, min(CAST(ts AS DATE)) + CASE WHEN user_id % 5 = 0 THEN 40 ELSE 0 END AS date FROM events WHERE event_type = 'view' GROUP BY user_id, event_id % 9)
SELECT event_id, CAST(coalesce(date, month_date) AS VARCHAR) AS sample_date, CASE WHEN date_trunc('month', date) <> date_trunc('month', month_date) THEN 'dust_exposure_date_conflict' END AS conflict FROM d LEFT JOIN o USING (gauge, block)""",
)
def dust_results(r: Roles) -> DataFrame:
    e = r.table("events").select("event_id", "event_type", "user_id", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("gauge"), (F.col("event_id") % 9).alias("block"), F.to_date("ts").alias("day"))
    d = e.where("event_type = 'click'").select("event_id", "gauge", "block", F.when(F.col("event_id") % 4 != 0, F.col("day")).alias("month_date"))
    o = e.where("event_type = 'view'").groupBy("gauge", "block", "user_id").agg(F.min("day").alias("d"))
    o = o.select("gauge", "block", F.date_add("d", F.when(F.col("user_id") % 5 == 0, 40).otherwise(0)).alias("date"), F.lit(None).cast("string").alias("comments"))
    return grids.dust_results(d, o).select("event_id", F.col("sample_date").cast("string").alias("sample_date"), "conflict")


@query(
    "i08_first_cell",
    """WITH g AS (SELECT 'u' || user_id AS file, event_id // 7 AS r, event_id % 7 AS c, event_type AS v FROM events) SELECT file, arg_min(r, c * 1000000 + r) AS r, min(c) AS c FROM g WHERE v = 'purchase' GROUP BY 1""",
)
def first_cell(r: Roles) -> DataFrame:
    g = r.table("events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file"), F.lit("").alias("sheet"), F.floor(F.col("event_id") / 7).alias("r"), (F.col("event_id") % 7).alias("c"), F.col("event_type").alias("v"))
    return grids.first_cell(g, "^PURCHASE$").select("file", "r", "c")


@query("c06_reconsidered_files", "SELECT hash, state, coalesce(state = 'failed' OR reason IN ('unclaimed', 'adapter_tie'), FALSE) AS again FROM (SELECT event_id AS hash, CASE event_id % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'quarantined' ELSE 'committed' END AS state, CASE event_id % 5 WHEN 0 THEN 'unclaimed' WHEN 1 THEN 'adapter_tie' WHEN 2 THEN 'empty_file' END AS reason FROM events)")
def reconsidered_files(r: Roles) -> DataFrame:
    k = F.col("event_id")
    e = r.table("events").select(k.alias("hash"), F.when(k % 3 == 0, "failed").when(k % 3 == 1, "quarantined").otherwise("committed").alias("state"), F.when(k % 5 == 0, "unclaimed").when(k % 5 == 1, "adapter_tie").when(k % 5 == 2, "empty_file").alias("reason"))
    return e.select("hash", "state", src.is_reconsidered(F.col("state"), F.col("reason")).alias("again"))


@query("a18_quarantine_report", r"SELECT page_id, nullif(regexp_extract(url, '[A-Z]{2}\d{7}', 0), '') AS work_order_guess FROM pages WHERE page_id % 3 IN (0, 1)")
def quarantine_report(r: Roles) -> DataFrame:
    k = F.col("page_id")
    f = r.table("pages").select("page_id", F.col("url").alias("filename"), F.when(k % 3 == 0, "failed").when(k % 3 == 1, "quarantined").otherwise("seen").alias("state"), k.alias("first_seen_at"))
    return store.quarantine_report(f).select("page_id", "work_order_guess")


@query("k10_month_age", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS age FROM orders")
def month_age(r: Roles) -> DataFrame:
    day = F.to_date("o_orderdate")
    return r.table("orders").select("o_orderkey", dates.month_of(day).alias("month"), F.datediff(F.lit("2001-08-02").cast("date"), day).cast("long").alias("age"))


@query("k06_date_bounds", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') END AS bound FROM events")
def date_bounds(r: Roles) -> DataFrame:
    k, ts = F.col("event_id"), F.col("ts").cast("timestamp_ntz")
    said = F.when(k % 3 == 0, F.date_format(ts, "yyyy-MM-dd")).when(k % 3 == 1, F.date_format(ts, "dd/MM/yyyy")).otherwise("2024-13-45")
    return r.table("events").select("event_id", dates.date_bound(said).cast("string").alias("bound"))


@query("l12_null_safe_match", "SELECT count(*) AS n FROM lab_method a JOIN lab_method b ON a.name = b.name AND a.method IS NOT DISTINCT FROM b.method AND a.organisation = b.organisation")
def null_safe_match(r: Roles) -> DataFrame:
    g = r.lab_method.groupBy("name", "method", "organisation").agg(F.count("*").alias("n"))
    return g.agg(F.sum(F.col("n") * F.col("n")).alias("n"))  # null-safe by grouping: pairs are counted, not made


@query("l11_scaled_values", "SELECT a.uuid, coalesce(a.value * m.conversion_constant, a.value) AS scaled FROM analysis a JOIN lab_method m ON a.uuid_lab = m.uuid")
def scaled_values(r: Roles) -> DataFrame:
    m = r.lab_method.select(F.col("uuid").alias("m"), "conversion_constant")
    return r.analysis.join(m, F.col("uuid_lab") == F.col("m")).select("uuid", rc.scaled(F.col("value"), F.col("conversion_constant")).alias("scaled"))


@query("l10_changelog_text", "SELECT o_orderkey, strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)), '%Y-%m-%d %H:%M:%S') AS said FROM orders")
def changelog_text(r: Roles) -> DataFrame:
    s = r.sample.select(F.substring("uuid", 2, 20).cast("long").alias("o_orderkey"), values.changelog_text(F.col("stamp"), "timestamp").alias("said"))
    return s


@query("j10_strip_bom", "SELECT doc_id, md5(text) AS plain_md5 FROM documents")
def strip_bom(r: Roles) -> DataFrame:
    mark = F.when(F.col("doc_id") % 3 == 0, "﻿").when(F.col("doc_id") % 3 == 1, "ï»¿").otherwise("")
    return r.table("documents").select("doc_id", F.md5(text.strip_bom(F.concat(mark, "text"))).alias("plain_md5"))


@query("j11_sample_types", "SELECT row, CASE row % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'Normal' WHEN 2 THEN 'LCS' ELSE 'unknown' END AS sample_type FROM raw")
def sample_types(r: Roles) -> DataFrame:
    k = F.col("row") % 4
    return r.raw.select("row", text.sample_type(F.when(k == 0, "").when(k == 1, " REG ").when(k == 2, "LCS")).alias("sample_type"))


@query("j15_code_patterns", r"SELECT count(*) FILTER (regexp_matches(c, '^[A-Z]{2}\d{7}\d*_[A-Z]{2}\d{7}$')) AS n_ncp, count(*) FILTER (regexp_matches(k, '^\d{2,7}-\d{2}-\d$')) AS n_cas FROM (SELECT 'XX' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || CASE o_orderkey % 3 WHEN 0 THEN '_YY' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') WHEN 1 THEN '001' ELSE '_Y1' END AS c, o_orderkey || '-' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || '-' || (o_orderkey % 12) AS k FROM orders)")
def code_patterns(r: Roles) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    s = lambda x: x.cast("string")
    code = F.concat(F.lit("XX"), F.lpad(s(k), 7, "0"), F.when(k % 3 == 0, F.concat(F.lit("_YY"), F.lpad(s(c), 7, "0"))).when(k % 3 == 1, "001").otherwise("_Y1"))
    cas = F.concat(s(k), F.lit("-"), F.lpad(s(c % 100), 2, "0"), F.lit("-"), s(k % 12))
    return r.table("orders").agg(F.count_if(code.rlike(text.NCP_CODE)).alias("n_ncp"), F.count_if(cas.rlike(text.CAS_NUMBER)).alias("n_cas"))


COUNTED = ("feature", "feature_alias", "sample", "analysis")


@query("e26_counts_checksum", " UNION ALL ".join(f"SELECT '{n}' AS tbl, count(*) AS n, count(DISTINCT uuid) AS n_keys, CAST(sum(h) AS BIGINT) AS total, bit_xor(h) AS mix FROM (SELECT uuid, CAST('0x' || substr(md5(uuid), 1, 8) AS BIGINT) AS h FROM {n})" for n in COUNTED))
def counts_checksum(r: Roles) -> DataFrame:
    """Counts of tables with a fingerprint of their keys, whatever their order."""
    out = None
    for name in COUNTED:
        row = getattr(r, name).agg(F.lit(name).alias("tbl"), F.countDistinct("uuid").alias("n_keys"), *reg.fingerprint(["uuid"]))
        out = row if out is None else out.union(row)
    return out


@query("e29_view_cardinality", "SELECT count(*) AS n FROM analysis a WHERE EXISTS (SELECT 1 FROM sample s JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid JOIN feature f ON fa.uuid_feature = f.uuid WHERE s.uuid = a.uuid_sample) AND EXISTS (SELECT 1 FROM lab_method m WHERE m.uuid = a.uuid_lab)")
def view_cardinality(r: Roles) -> DataFrame:
    fa = r.feature_alias.join(r.feature.select(F.col("uuid").alias("uuid_feature")), "uuid_feature", "left_semi").select(F.col("uuid").alias("uuid_feature_alias"))
    s = r.sample.join(fa, "uuid_feature_alias", "left_semi").select(F.col("uuid").alias("uuid_sample"))
    m = r.lab_method.select(F.col("uuid").alias("uuid_lab"))
    return r.analysis.join(s, "uuid_sample", "left_semi").join(m, "uuid_lab", "left_semi").agg(F.count("*").alias("n"))


@query("p43_view_deltas", "SELECT k.variant, count(*) AS n_after, count(*) FILTER (f.date_end IS NULL) AS n_before, count(*) - count(*) FILTER (f.date_end IS NULL) AS delta FROM mask k JOIN feature f ON k.uuid_feature = f.uuid GROUP BY 1")
def view_deltas(r: Roles) -> DataFrame:
    rows = r.mask.join(r.feature.select("uuid", "date_end"), F.col("uuid_feature") == F.col("uuid"))
    g = rows.groupBy("variant").agg(F.count("*").alias("n_after"), F.count_if(F.col("date_end").isNull()).alias("n_before"))
    return g.withColumn("delta", F.col("n_after") - F.col("n_before"))


@query("d08_structural_lookup", r"SELECT c_custkey, f.uuid AS uuid_feature FROM customer c JOIN feature f ON upper(f.site) || '|' || regexp_replace(upper(substr(f.name, length(f.site) + 2)), '(^|[^0-9])0+([0-9])', '\1\2', 'g') = 'NATION_' || c_nationkey || '|' || substr(c_mktsegment, 1, 1) || c_custkey WHERE f.date_end IS NULL OR f.date_end >= DATE '1999-01-01'")
def structural_lookup(r: Roles) -> DataFrame:
    rows = r.table("customer").select(
        F.col("c_custkey").alias("row"), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("site"),
        F.concat(F.substring("c_mktsegment", 1, 1), F.col("c_custkey").cast("string")).alias("point"), F.lit("1999-01-01").cast("date").alias("day"),
    )
    return rs.structural_hits(rows, rs.structural_index(r.feature)).select(F.col("row").alias("c_custkey"), "uuid_feature")


@query("d09_self_alias_lookup", "SELECT f.uuid, min(fa.uuid) AS uuid_alias FROM feature f LEFT JOIN feature_alias fa ON fa.uuid_feature = f.uuid AND fa.kind = 'self' GROUP BY 1")
def self_alias_lookup(r: Roles) -> DataFrame:
    own = r.feature_alias.where("kind = 'self' and uuid_feature is not null").groupBy(F.col("uuid_feature").alias("uuid")).agg(F.min("uuid").alias("uuid_alias"))
    return r.feature.select("uuid").join(own, "uuid", "left")


@query("d15_method_analyte", "SELECT a.uuid, m.uuid_analyte FROM analysis a LEFT JOIN lab_method m ON a.uuid_lab = m.uuid")
def method_analyte(r: Roles) -> DataFrame:
    return r.analysis.join(r.lab_method.select(F.col("uuid").alias("uuid_lab"), "uuid_analyte"), "uuid_lab", "left").select("uuid", "uuid_analyte")


@query("d34_orphaned_arms", "SELECT fa.uuid FROM feature_alias fa WHERE fa.uuid_feature IS NULL AND EXISTS (SELECT 1 FROM sample s WHERE s.uuid_feature_alias = fa.uuid AND s.person <> '5-LOW')")
def orphaned_arms(r: Roles) -> DataFrame:
    used = r.sample.where("person <> '5-LOW'").select(F.col("uuid_feature_alias").alias("uuid"))
    return r.feature_alias.where("uuid_feature is null").join(used, "uuid", "left_semi").select("uuid")


@query("d35_bounds_match", "SELECT f.name, count(*) = 1 AS exactly_one FROM feature_alias fa JOIN feature f ON fa.uuid_feature = f.uuid WHERE fa.kind <> 'self' GROUP BY f.uuid, f.name")
def bounds_match(r: Roles) -> DataFrame:
    rows = r.feature_alias.where("kind <> 'self'").join(r.feature.select(F.col("uuid").alias("uuid_feature"), F.col("name").alias("feature")), "uuid_feature")
    return rows.groupBy("uuid_feature", "feature").agg((F.count("*") == 1).alias("exactly_one")).select(F.col("feature").alias("name"), "exactly_one")


@query("c14_implausible_values", "WITH g AS (SELECT m.uuid_analyte, count(*) AS n, min(a.value) AS lo, max(a.value) AS hi FROM analysis a JOIN lab_method m ON a.uuid_lab = m.uuid WHERE a.value > 0 AND m.uuid_analyte IS NOT NULL GROUP BY 1) SELECT i.row FROM incoming i JOIN g USING (uuid_analyte) WHERE n >= 30 AND i.value * 12 > 0 AND (i.value * 12 < lo / 10 OR i.value * 12 > hi * 10 OR i.value * 12 > 500)")
def implausible_values(r: Roles) -> DataFrame:
    from ..operators.statistics import value_ranges

    g = value_ranges(r.analysis, r.lab_method)
    rows = r.incoming.join(g, "uuid_analyte")
    return rows.where(values.implausible(F.col("value") * 12, F.col("n"), F.col("low"), F.least("high", F.lit(50.0)))).select("row")


@query("f11_method_headings", "WITH c AS (SELECT 'u' || user_id AS file, event_id AS r, CASE WHEN event_type = 'signup' THEN 'M' || event_id END AS head, event_type = 'error' AS mark FROM events), s AS (SELECT *, sum(CASE WHEN mark THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY r) AS section FROM c) SELECT file, r, last_value(head IGNORE NULLS) OVER (PARTITION BY file, section ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS method FROM s")
def method_headings(r: Roles) -> DataFrame:
    k = F.col("event_type")
    c = r.table("events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file"), F.col("event_id").alias("r"), F.when(k == "signup", F.concat(F.lit("M"), F.col("event_id").cast("string"))).alias("head"), (k == "error").alias("mark"))
    s = grids.sections(c, ["file"], F.col("mark"), F.lit(True))
    return s.select("file", "r", grids.carried(F.col("head"), ["file", "section"], "r").alias("method"))


@query("b06_scaled_commit", "SELECT m.organisation, count(*) AS n, sum(coalesce(a.value * m.conversion_constant, a.value)) AS total, sum(coalesce(a.rl_low * m.conversion_constant, a.rl_low)) AS rl_total FROM analysis a JOIN lab_method m ON a.uuid_lab = m.uuid GROUP BY 1")
def scaled_commit(r: Roles) -> DataFrame:
    m = r.lab_method.select(F.col("uuid").alias("m"), "conversion_constant", "organisation")
    rows = r.analysis.join(m, F.col("uuid_lab") == F.col("m"))
    c = F.col("conversion_constant")
    return rows.groupBy("organisation").agg(F.count("*").alias("n"), F.sum(rc.scaled(F.col("value"), c)).alias("total"), F.sum(rc.scaled(F.col("rl_low"), c)).alias("rl_total"))


