"""Queries of entity resolution and registry upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import registry as reg
from ..operators import resolve as rs
from ..operators import reviews as rv
from ..warehouse.scratch import written
from .registry import query
from .roles import Roles

#: Rows to resolve: every sample by a name, part of them codes of the alias registry.
NAMES = """
names AS (
  SELECT s.uuid AS row, 'e' || (CAST(substr(s.uuid, 2) AS BIGINT) % 400) AS event, CAST(substr(s.uuid, 2) AS BIGINT) % 400 = 7 AS orphan,
    CASE CAST(substr(s.uuid, 2) AS BIGINT) % 6
      WHEN 0 THEN upper(p.p_name) WHEN 1 THEN p.p_name || ' ' || p.p_partkey WHEN 2 THEN ' ' || f.name || ' '
      WHEN 3 THEN f.site || ' ' || replace(substr(f.name, length(f.site) + 2), '0', '00') WHEN 4 THEN substr(f.name, length(f.site) + 2) ELSE CASE WHEN s.datetime IS NULL THEN ' - ' ELSE 'nowhere ' || f.flow END END AS raw,
    CAST(s.stamp AS DATE) AS day, 1.0 AS confidence, p.p_type AS analyte_raw
  FROM sample s JOIN orders o ON s.uuid = 's' || o.o_orderkey JOIN feature f ON f.uuid = 'f' || o.o_custkey JOIN part p ON p.p_partkey = o.o_orderkey % 200),
keyed AS (SELECT *, CASE WHEN regexp_matches(raw, '[A-Za-z0-9]') THEN lower(trim(raw)) END AS key FROM names)
"""

#: Aliases of a row's key, as SQL.
MATCHED = f"""{NAMES},
matched AS (
  SELECT k.row, k.day, fa.uuid AS fa_uuid, fa.uuid_feature, fa.kind, fa.auto_assign,
    (fa.date_start IS NULL OR fa.date_start <= k.day) AND (fa.date_end IS NULL OR fa.date_end >= k.day) AS is_live,
    (f.date_end IS NULL OR f.date_end >= k.day) AS feature_live
  FROM keyed k JOIN feature_alias fa ON fa.alias_key = k.key LEFT JOIN feature f ON f.uuid = fa.uuid_feature),
cand AS (SELECT * FROM matched WHERE is_live AND auto_assign AND uuid_feature IS NOT NULL AND feature_live),
won AS (
  SELECT row, CASE WHEN count(DISTINCT uuid_feature) = 1 THEN arg_min(uuid_feature, CASE WHEN kind = 'self' THEN '0' ELSE '1' END || fa_uuid) ELSE arg_min(uuid_feature, fa_uuid) FILTER (kind = 'self') END AS uuid_feature,
    CASE WHEN count(DISTINCT uuid_feature) = 1 THEN arg_min(fa_uuid, CASE WHEN kind = 'self' THEN '0' ELSE '1' END || fa_uuid) ELSE min(fa_uuid) FILTER (kind = 'self') END AS uuid_alias,
    CASE WHEN count(DISTINCT uuid_feature) = 1 THEN 'alias' ELSE 'self_precedence' END AS resolution, count(DISTINCT uuid_feature) AS n_features
  FROM cand GROUP BY row HAVING count(DISTINCT uuid_feature) = 1 OR count(DISTINCT uuid_feature) FILTER (kind = 'self') = 1)
"""


def names(r: Roles) -> DataFrame:
    """Orders, whose samples they are, meet customers and parts by number; names are made afterwards, so that no shuffle moves them."""
    k, sample, (name, _) = F.col("o_orderkey"), r._sample(), r._names()
    own = r.table("customer").join(r.site, F.col("c_nationkey") == F.col("k")).select("c_custkey", "c_mktsegment", "site")
    p = r.table("part").where("p_partkey between -199 and 199").select("p_partkey", "p_name", "p_type")
    rows = r.table("orders").select("o_orderkey", "o_custkey", "o_orderdate").join(own, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(F.broadcast(p), F.col("p_partkey") == k % 200)  # a part for each remainder
    point = F.substring(name, F.length("site") + 2, F.length(name))
    raw = (
        F.when(k % 6 == 0, F.upper("p_name"))
        .when(k % 6 == 1, F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")))
        .when(k % 6 == 2, F.concat(F.lit(" "), name, F.lit(" ")))
        .when(k % 6 == 3, F.concat("site", F.lit(" "), F.replace(point, F.lit("0"), F.lit("00"))))
        .when(k % 6 == 4, point)
        .when(sample["datetime"].isNull(), " - ")
        .otherwise(F.concat(F.lit("nowhere "), "c_mktsegment"))
    )
    return rows.select(
        sample["uuid"].alias("row"), F.concat(F.lit("e"), (k % 400).cast("string")).alias("event"), (k % 400 == 7).alias("orphan"), raw.alias("raw"),
        F.to_date(sample["stamp"]).alias("day"), F.lit(1.0).alias("confidence"), F.col("p_type").alias("analyte_raw"),
    )


def keyed(r: Roles) -> DataFrame:
    return names(r).select("row", text.feature_key(F.col("raw")).alias("key"), "day").where("key is not null")


def joined(c: Column) -> Column:
    return F.array_join(c, ",")


@query("d02_interval_candidates", f"WITH {MATCHED} SELECT row, fa_uuid, uuid_feature FROM cand")
def interval_candidates(r: Roles) -> DataFrame:
    return rs.candidates(keyed(r), r.feature_alias, r.feature).select("row", "fa_uuid", F.col("fa_uuid_feature").alias("uuid_feature"))


@query(
    "d04_conditional_narrowing",
    f"""WITH {MATCHED}, w AS (SELECT *, (SELECT count(DISTINCT uuid_feature) FROM matched x WHERE x.row = m.row) AS n, max(CAST(is_live AS INT)) OVER (PARTITION BY row) AS any_live FROM matched m)
SELECT row, fa_uuid FROM w WHERE NOT (n > 1 AND any_live = 1) OR is_live""",
)
def conditional_narrowing(r: Roles) -> DataFrame:
    return rs.narrowed_matches(keyed(r), r.feature_alias, r.feature).select("row", "fa_uuid")


@query("d05_suggestions", f"WITH {MATCHED} SELECT row, string_agg(DISTINCT uuid_feature, ',' ORDER BY uuid_feature) AS features FROM matched WHERE is_live AND uuid_feature IS NOT NULL AND feature_live GROUP BY row")
def suggestions(r: Roles) -> DataFrame:
    return rs.suggestions(keyed(r), r.feature_alias, r.feature, joined)


@query("d06_expired_aliases", f"WITH {MATCHED} SELECT row, string_agg(DISTINCT fa_uuid, ',' ORDER BY fa_uuid) AS aliases FROM matched WHERE NOT is_live GROUP BY row")
def expired_aliases(r: Roles) -> DataFrame:
    return rs.expired(keyed(r), r.feature_alias, r.feature, joined)


@query("d07_known_keys", f"WITH {NAMES} SELECT EXISTS (SELECT 1 FROM feature_alias fa WHERE fa.alias_key = k.key) AS known, count(*) AS n FROM keyed k WHERE key IS NOT NULL GROUP BY 1")
def known_keys(r: Roles) -> DataFrame:
    known = r.feature_alias.select(F.col("alias_key").alias("key"))
    rows = written(keyed(r), "names-keyed")  # read twice
    semi = rows.join(known, "key", "left_semi").select(F.lit(True).alias("known"))
    return semi.union(rows.join(known, "key", "left_anti").select(F.lit(False))).groupBy("known").agg(F.count("*").alias("n"))


@query("f08_self_precedence", f"WITH {MATCHED} SELECT row, uuid_feature, uuid_alias, resolution FROM won")
def self_precedence(r: Roles) -> DataFrame:
    return rs.layer_one(keyed(r), r.feature_alias, r.feature).select("row", "uuid_feature", "uuid_alias", "resolution")


@query(
    "d26_structural_index",
    r"""SELECT upper(site) || '|' || regexp_replace(upper(substr(name, length(site) + 2)), '(^|[^0-9])0+([0-9])', '\1\2', 'g') AS key, uuid AS uuid_feature FROM feature""",
)
def structural_index(r: Roles) -> DataFrame:
    return rs.structural_index(r.feature).select("key", "uuid_feature")


LAYERS = rf"""{MATCHED},
idx AS (SELECT upper(site) || '|' || regexp_replace(upper(substr(name, length(site) + 2)), '(^|[^0-9])0+([0-9])', '\1\2', 'g') AS k, uuid AS uuid_feature, date_end FROM feature),
own AS (SELECT uuid_feature, min(uuid) AS uuid_alias FROM feature_alias WHERE kind = 'self' AND uuid_feature IS NOT NULL GROUP BY 1),
one AS (SELECT k.*, w.uuid_feature AS f1, w.uuid_alias AS a1, w.resolution AS r1, EXISTS (SELECT 1 FROM feature_alias fa WHERE fa.alias_key = k.key) AS known FROM keyed k LEFT JOIN won w USING (row)),
sited AS (SELECT o.*, (SELECT arg_min(site, -1000 * length(site)) FROM (SELECT DISTINCT site FROM feature) s WHERE starts_with(o.key, lower(s.site)) AND length(o.key) > length(s.site)) AS st FROM one o),
parsed AS (SELECT *, substr(key, length(st) + 1, 1) IN ('.', ' ') AS boundary, CASE WHEN substr(key, length(st) + 1, 1) IN ('.', ' ') THEN substr(key, length(st) + 2) ELSE substr(key, length(st) + 1) END AS rest FROM sited),
pointed AS (SELECT *, CASE WHEN rest <> '' AND NOT regexp_matches(rest, '[. ]') THEN regexp_replace(upper(rest), '(^|[^0-9])0+([0-9])', '\1\2', 'g') END AS pt FROM parsed),
two AS (SELECT p.row, min(i.uuid_feature) AS f FROM pointed p JOIN idx i ON i.k = upper(p.st) || '|' || p.pt WHERE p.f1 IS NULL AND NOT p.known AND p.boundary
  GROUP BY p.row, p.day HAVING count(DISTINCT i.uuid_feature) = 1 AND (max(i.date_end) IS NULL OR max(i.date_end) >= p.day)),
done AS (SELECT p.*, coalesce(p.f1, o.uuid_feature) AS f2, coalesce(p.a1, o.uuid_alias) AS a2, coalesce(p.r1, CASE WHEN o.uuid_feature IS NOT NULL THEN 'structural' END) AS r2
  FROM pointed p LEFT JOIN two t USING (row) LEFT JOIN own o ON o.uuid_feature = t.f),
ev AS (SELECT event, min(f.site) AS es FROM done d JOIN feature f ON f.uuid = d.f2 GROUP BY 1 HAVING count(DISTINCT f.site) = 1),
three AS (SELECT d.row, min(i.uuid_feature) AS f FROM done d JOIN ev USING (event) JOIN idx i ON i.k = upper(ev.es) || '|' || regexp_replace(upper(d.key), '(^|[^0-9])0+([0-9])', '\1\2', 'g')
  WHERE d.f2 IS NULL AND d.key IS NOT NULL AND NOT d.known AND d.st IS NULL AND NOT d.orphan AND NOT regexp_matches(d.key, '[. ]')
  GROUP BY d.row, d.day HAVING count(DISTINCT i.uuid_feature) = 1 AND (max(i.date_end) IS NULL OR max(i.date_end) >= d.day)),
resolved AS (SELECT d.row, d.event, d.key, d.raw, d.st IS NOT NULL AS has_site, CASE WHEN d.key IS NULL THEN 'held' WHEN coalesce(d.f2, o.uuid_feature) IS NOT NULL THEN 'hit' ELSE 'pending' END AS status, coalesce(d.f2, o.uuid_feature) AS uuid_feature,
  coalesce(d.a2, o.uuid_alias) AS uuid_alias, coalesce(d.r2, CASE WHEN o.uuid_feature IS NOT NULL THEN 'site_inferred' END) AS resolution
  FROM done d LEFT JOIN three t USING (row) LEFT JOIN own o ON o.uuid_feature = t.f)
"""


@query(
    "p05_resolve_features",
    f"""WITH {LAYERS} SELECT row, status, uuid_feature, uuid_alias, resolution, CAST(CASE resolution WHEN 'structural' THEN 0.9 WHEN 'site_inferred' THEN 0.8 ELSE 1.0 END AS DOUBLE) AS confidence FROM resolved""",
)
def resolve_features(r: Roles) -> DataFrame:
    return rs.resolve_features(names(r), r.feature_alias, r.feature).select("row", "status", "uuid_feature", "uuid_alias", "resolution", "confidence")


@query(
    "n11_feature_review",
    f"""WITH {LAYERS},
sug AS (SELECT row, list(DISTINCT uuid_feature) AS s FROM matched WHERE is_live AND uuid_feature IS NOT NULL AND feature_live GROUP BY 1),
ex AS (SELECT row, count(DISTINCT fa_uuid) AS n FROM matched WHERE NOT is_live GROUP BY 1), ca AS (SELECT row, count(DISTINCT uuid_feature) AS n FROM cand GROUP BY 1)
SELECT key, CASE WHEN status = 'held' THEN 'held' WHEN coalesce(ca.n, 0) >= 2 OR coalesce(len(s), 0) >= 2 THEN 'ambiguous' WHEN len(s) = 1 THEN 'suggestion' WHEN ex.n > 0 THEN 'expired_alias' WHEN has_site THEN 'structural' END AS subkind,
  count(*) AS n_rows, md5(string_agg(row, ',' ORDER BY row)) AS refs_md5, coalesce(string_agg(u, ',') FILTER (FALSE), '') AS none
FROM resolved LEFT JOIN sug USING (row) LEFT JOIN ex USING (row) LEFT JOIN ca USING (row), (SELECT '' AS u) WHERE status <> 'hit' GROUP BY 1, 2""",
)
def feature_review(r: Roles) -> DataFrame:
    resolved = rs.resolve_features(names(r), r.feature_alias, r.feature).where("status <> 'hit'").select("row", "key", "status", "site")
    out = resolved.join(rs.evidence(keyed(r), r.feature_alias, r.feature, F.size), "row", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    sub = rs.subkind(F.col("status"), n("candidates"), n("suggestions"), n("expired"), F.col("site").isNotNull())
    rows = out.select("key", sub.alias("subkind"), F.col("row").alias("source_ref"), F.lit(None).cast("array<string>").alias("candidates"))
    g = rv.review_rows(rows, ["key", "subkind"])
    return g.select("key", "subkind", "n_rows", F.md5("source_ref").alias("refs_md5"), F.array_join("candidates", ",").alias("none"))


METHOD_ROWS = """
asked AS (SELECT uuid AS row, CASE CAST(substr(uuid, 3) AS INT) % 4 WHEN 0 THEN name WHEN 1 THEN lower(name) || '-' WHEN 2 THEN name ELSE CASE WHEN CAST(substr(uuid, 3) AS INT) % 8 = 3 THEN '--' ELSE 'Unknown' END END AS analyte_raw,
  CASE WHEN CAST(substr(uuid, 3) AS INT) % 10 = 0 THEN NULL ELSE organisation END AS org, CASE WHEN CAST(substr(uuid, 3) AS INT) % 4 = 2 THEN lower(method) || '.' ELSE method END AS method_raw FROM lab_method)
"""


METHODS = rf"""{METHOD_ROWS},
k AS (SELECT *, nullif(lower(regexp_replace(analyte_raw, '[^A-Za-z0-9]', '', 'g')), '') AS nk, nullif(lower(regexp_replace(method_raw, '[^A-Za-z0-9]', '', 'g')), '') AS mk FROM asked),
m AS (SELECT *, nullif(lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')), '') AS nk, nullif(lower(regexp_replace(method, '[^A-Za-z0-9]', '', 'g')), '') AS mk FROM lab_method),
j AS (SELECT k.row, m.uuid, m.uuid_analyte, m.name = k.analyte_raw AND m.method IS NOT DISTINCT FROM k.method_raw AS exact, coalesce(m.mk = k.mk, FALSE) AS near FROM k JOIN m ON m.nk = k.nk AND m.organisation = k.org),
g AS (SELECT row, min(uuid) FILTER (exact) AS ex, count(*) > 1 AND count(*) FILTER (near) > 0 AS narrow, count(DISTINCT coalesce(uuid_analyte, '')) AS n_all, count(DISTINCT coalesce(uuid_analyte, '')) FILTER (near) AS n_near, min(uuid) AS u, min(uuid) FILTER (near) AS un FROM j GROUP BY 1),
p AS (SELECT k.row, k.nk, k.org, g.row IS NOT NULL AS found, CASE WHEN ex IS NOT NULL THEN ex WHEN narrow AND n_near = 1 THEN un WHEN NOT narrow AND n_all = 1 THEN u END AS pick FROM k LEFT JOIN g USING (row))
"""
METHOD_STATUS = "SELECT p.row, CASE WHEN nk IS NULL THEN 'held' WHEN org IS NULL OR NOT found THEN 'miss' WHEN pick IS NULL THEN 'ambiguous' WHEN m.uuid_analyte IS NULL THEN 'dangling_method' ELSE 'resolved' END AS status, pick AS uuid_lab, m.uuid_analyte FROM p LEFT JOIN lab_method m ON m.uuid = p.pick"


def asked(r: Roles) -> DataFrame:
    n = F.substring("uuid", 3, 20).cast("int")
    return r.lab_method.select(
        F.col("uuid").alias("row"),
        F.when(n % 4 == 1, F.concat(F.lower("name"), F.lit("-"))).when((n % 4 == 3) & (n % 8 == 3), "--").when(n % 4 == 3, "Unknown").otherwise(F.col("name")).alias("analyte_raw"),
        F.when(n % 10 != 0, F.col("organisation")).alias("org"),
        F.when(n % 4 == 2, F.concat(F.lower("method"), F.lit("."))).otherwise(F.col("method")).alias("method_raw"),
    )


@query("d11_resolve_methods", f"WITH {METHODS} {METHOD_STATUS}")
def resolve_methods(r: Roles) -> DataFrame:
    return rs.resolve_methods(asked(r), r.lab_method)


@query(
    "p06_resolve_analytes",
    f"""WITH {METHODS}, res AS ({METHOD_STATUS}), an AS (SELECT 'C' || (length(uuid) % 7) AS cas, min(uuid) AS u FROM analyte GROUP BY 1)
SELECT row, status, uuid_lab, uuid_analyte, status <> 'held' AND uuid_analyte IS NULL AS analyte_pending, CASE WHEN status <> 'held' AND uuid_lab IS NULL AND uuid_analyte IS NULL AND CAST(substr(row, 3) AS INT) % 3 <> 0 THEN u END AS suggested
FROM res LEFT JOIN an ON an.cas = 'C' || (CAST(substr(row, 3) AS INT) % 9)""",
)
def resolve_analytes(r: Roles) -> DataFrame:
    """The whole analyte resolver: methods by name, what stays pending, and analytes that a CAS number suggests."""
    n = F.substring("row", 3, 20).cast("int")
    rows = asked(r).withColumn("cas_number", F.when(n % 3 != 0, F.concat(F.lit("C"), (n % 9).cast("string"))))
    an = r.analyte.withColumn("cas", F.concat(F.lit("C"), (F.length("uuid") % 7).cast("string")))
    return rs.resolve_analytes(rows, r.lab_method, an).select("row", "status", "uuid_lab", "uuid_analyte", "analyte_pending", "suggested")



DAY = "CAST(s.datetime AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS DATE)"


@query(
    "d20_alias_collisions",
    f"""WITH x AS (SELECT s.uuid, fa.uuid_feature, fa.uuid AS fa, date_trunc('month', {DAY}) AS day FROM sample s JOIN feature_alias fa ON s.uuid_feature_alias = fa.uuid WHERE uuid_feature IS NOT NULL)
SELECT a.uuid_feature, strftime(a.day, '%Y-%m') AS day, a.uuid, a.fa, count(*) AS n_links FROM x a JOIN x b ON a.uuid_feature = b.uuid_feature AND a.day = b.day AND a.fa <> b.fa GROUP BY ALL""",
)
def alias_collisions(r: Roles) -> DataFrame:
    """By month: the tables have no two aliases of a feature on one day."""
    return reg.collisions(r.sample, r.feature_alias, dates.month_of(dates.civil_date(F.col("datetime"))))


@query(
    "d21_self_collisions",
    f"""WITH x AS (SELECT s.uuid, uuid_feature_alias, {DAY} AS day FROM sample s)
SELECT a.uuid_feature_alias, CAST(a.day AS VARCHAR) AS day, a.uuid, count(*) AS n_links FROM x a JOIN x b ON a.uuid_feature_alias = b.uuid_feature_alias AND a.day = b.day AND b.uuid <> a.uuid GROUP BY ALL""",
)
def self_collisions(r: Roles) -> DataFrame:
    return reg.self_collisions(r.sample, dates.civil_date(F.col("datetime"))).withColumn("day", F.col("day").cast("string"))


@query(
    "d22_identity_duplicates",
    """WITH fb AS (SELECT * FROM feature_alias UNION ALL SELECT 'dup' || uuid, uuid, lower(name), name, 'historical_code', TRUE, NULL, NULL FROM feature WHERE date_end IS NOT NULL)
SELECT s.uuid_feature AS "of", s.uuid AS uuid_self, o.uuid AS uuid_other FROM fb s JOIN fb o ON s.uuid_feature = o.uuid_feature AND s.alias_key = o.alias_key JOIN feature f ON f.uuid = s.uuid_feature AND lower(f.name) = s.alias_key
WHERE s.kind = 'self' AND o.kind <> 'self'""",
)
def identity_duplicates(r: Roles) -> DataFrame:
    f = r.feature.where("date_end is not null")
    none = F.lit(None).cast("date")
    extra = f.select(
        F.concat(F.lit("dup"), "uuid").alias("uuid"), F.col("uuid").alias("uuid_feature"), F.lower("name").alias("alias_key"), "name",
        F.lit("historical_code").alias("kind"), F.lit(True).alias("auto_assign"), none.alias("date_start"), none.alias("date_end"),
    )
    return reg.identity_duplicates(r.feature_alias.unionByName(extra), r.feature)


@query("d31_without_self_alias", "SELECT uuid, name FROM feature f WHERE NOT EXISTS (SELECT 1 FROM feature_alias fa WHERE fa.uuid_feature = f.uuid AND fa.kind = 'self')")
def without_self(r: Roles) -> DataFrame:
    return reg.without_self(r.feature, r.feature_alias).select("uuid", "name")


@query("p42_ambiguous_keys", "SELECT alias_key, count(DISTINCT uuid_feature) AS n_features, count(*) AS n_aliases FROM feature_alias WHERE uuid_feature IS NOT NULL GROUP BY 1 HAVING count(DISTINCT uuid_feature) > 1")
def ambiguous_keys(r: Roles) -> DataFrame:
    return reg.ambiguous_keys(r.feature_alias)


@query("e13_unique_violations", "SELECT uuid_feature_alias, CAST(datetime AS VARCHAR) AS instant, uuid_project, count(*) AS n, min(uuid) AS exemplar FROM sample WHERE uuid_feature_alias IS NOT NULL AND datetime IS NOT NULL AND uuid_project IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1")
def unique_violations(r: Roles) -> DataFrame:
    return reg.violations(r.sample.withColumn("instant", F.col("datetime").cast("string")), ["uuid_feature_alias", "instant", "uuid_project"])


@query(
    "d24_containment",
    """WITH t AS (SELECT uuid_lab, value, quantified, rl_low, revision FROM analysis WHERE quantified IS NOT TRUE), u AS (SELECT uuid_lab, value, quantified, rl_low, revision FROM analysis WHERE revision < 6)
SELECT count(*) AS n_missing FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.uuid_lab = t.uuid_lab AND u.value IS NOT DISTINCT FROM t.value AND u.quantified IS NOT DISTINCT FROM t.quantified AND u.rl_low IS NOT DISTINCT FROM t.rl_low)""",
)
def containment(r: Roles) -> DataFrame:
    a = r.analysis
    missing = reg.not_contained(a.where("quantified is not true"), a.where("revision < 6"), ["uuid_lab", "value", "quantified", "rl_low"])
    return missing.agg(F.count("*").alias("n_missing"))


@query(
    "j18_alias_rows",
    r"""WITH t AS (SELECT uuid AS uuid_feature, name FROM feature UNION ALL SELECT uuid, trim(unnest(string_split(flow || ', ' || site || ' ' || flow || ',,' || lower(name), ','))) FROM feature),
k AS (SELECT uuid_feature, lower(trim(name)) AS alias_key FROM t WHERE name <> ''), g AS (SELECT alias_key, uuid_feature, count(*) AS n_seen FROM k GROUP BY 1, 2)
SELECT alias_key, uuid_feature, n_seen, count(*) OVER (PARTITION BY alias_key) = 1 AS auto_assign FROM g""",
)
def alias_rows(r: Roles) -> DataFrame:
    f = r.feature.select(F.col("uuid").alias("uuid_feature"), "name", F.concat("flow", F.lit(", "), "site", F.lit(" "), "flow", F.lit(",,"), F.lower("name")).alias("cypher"))
    return reg.alias_rows(f, f)
