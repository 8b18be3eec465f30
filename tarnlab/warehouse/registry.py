"""Edits of the registry and the review queue, each one logged transaction of a store."""

from __future__ import annotations

import uuid as ids

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, units, values
from .ingest import SCHEMA, made, shaped
from .scratch import written
from .store import Store

# Which columns refer to a table's rows.
REFERENCES = {
    "feature": (("feature_alias", "uuid_feature"), ("review_queue_candidate", "uuid_feature")),
    "feature_alias": (("sample", "uuid_feature_alias"), ("resolution", "uuid_alias")),
    "analyte": (("lab_method", "uuid_analyte"),),
    "lab_method": (("analysis", "uuid_lab"),),
    "sample": (("analysis", "uuid_sample"), ("resolution", "uuid_sample")),
    "project": (("sample", "uuid_project"), ("asset", "uuid_project"), ("project", "uuid_parent"), ("project", "uuid_root")),
    "review_queue": (("review_queue_candidate", "uuid_review"),),
}


def _one(store: Store, table: str, **fields) -> DataFrame:
    types = dict(p.split() for p in SCHEMA[table].split(", "))
    unknown = set(fields) - set(types)
    if unknown:
        raise ValueError(f"{table} has no {sorted(unknown)}")
    return store.spark.range(1).select(*[F.lit(fields.get(n)).cast(t).alias(n) for n, t in types.items()])


def add_feature(store: Store, name: str, site: str, lon: float, lat: float, actor: str, reason: str, **fields) -> str:
    """A new sampling point with its own alias; its id. Refused if another point has the name, or it has no letter or digit.

    An alias without a point doesn't stand in the way: confirming it is the next step.
    """
    key = store.spark.range(1).select(text.feature_key(F.lit(name))).first()[0]
    if key is None:
        raise ValueError(f"{name!r} has no letter or digit")
    uuid = str(ids.uuid4())
    with store.transaction():
        taken = store.read("feature_alias").where((F.col("alias_key") == key) & F.col("uuid_feature").isNotNull())
        if not taken.isEmpty():
            raise ValueError(f"{name!r} is already the name of a point")
        store.append("feature", _one(store, "feature", uuid=uuid, name=name, site=site, lon=lon, lat=lat, **fields), actor, reason)
        own = _one(store, "feature_alias", uuid=str(ids.uuid4()), uuid_feature=uuid, alias_key=key, name=name, kind="self", auto_assign=True, n_seen=0, comments="own name")
        store.append("feature_alias", own, actor, reason)
    return uuid


def add_analyte(store: Store, name: str, actor: str, reason: str, **fields) -> str:
    uuid = str(ids.uuid4())
    store.append("analyte", _one(store, "analyte", uuid=uuid, name=name, **fields), actor, reason)
    return uuid


def add_project(store: Store, name: str, actor: str, reason: str, type: str = "Work order", **fields) -> str:
    uuid = str(ids.uuid4())
    store.append("project", _one(store, "project", uuid=uuid, name=name, type=type, **fields), actor, reason)
    return uuid


def add_review(store: Store, kind: str, actor: str, candidates: tuple[str, ...] = (), **fields) -> str:
    """An open question with its ranked candidates, together; its id."""
    uuid = str(ids.uuid4())
    with store.transaction():
        store.append("review_queue", _one(store, "review_queue", uuid=uuid, kind=kind, status="open", **fields), actor, "question")
        if candidates:
            rows = store.spark.createDataFrame([(uuid, i, c) for i, c in enumerate(candidates, 1)], "uuid_review string, rank int, uuid_feature string")
            store.append("review_queue_candidate", shaped(rows.withColumn("uuid", made("rc-", "uuid_review", "rank")), "review_queue_candidate"), actor, "candidates")
    return uuid


def review_queue(store: Store, status: str = "open") -> DataFrame:
    return store.read("review_queue").where(F.col("status") == status)


def resolve_review(store: Store, uuid: str, resolution: str, resolved_by: str) -> bool:
    """Close one open question; False if there is none."""
    with store.transaction():
        hit = store.read("review_queue").where((F.col("uuid") == uuid) & (F.col("status") == "open"))
        if hit.isEmpty():
            return False
        change = hit.select("uuid", F.lit("closed").alias("status"), F.lit(resolution).alias("resolution"), F.lit(resolved_by).alias("resolved_by"))
        store.update("review_queue", written(change, "registry-review"), resolved_by, resolution)
        return True


def dependents(read, table: str, uuids: DataFrame) -> DataFrame:
    """Rows that refer to rows of a table: uuid, tbl, field, uuid_row. read gives a table by its name."""
    out = None
    for name, column in REFERENCES[table]:
        rows = read(name).where(F.col(column).isNotNull()).select(F.col(column).alias("uuid"), F.lit(name).alias("tbl"), F.lit(column).alias("field"), F.col("uuid").alias("uuid_row"))
        rows = rows.join(uuids.select("uuid").distinct(), "uuid", "left_semi")
        out = rows if out is None else out.union(rows)
    return out


def target_is_self(alias_key: Column, feature_name: Column) -> Column:
    """Whether an alias is a point's own name."""
    return values.is_true(alias_key == text.feature_key(feature_name))


def converted_analyses(analysis: DataFrame, method: DataFrame, analyte: DataFrame, done: DataFrame) -> DataFrame:
    """Stored analyses of methods (uuid, units, uuid_analyte) in their analyte's unit: uuid, value, rl_low, status.

    converted, same_unit, or incompatible (null values: leave them). Analyses in done were
    converted before and don't appear.
    """
    m = method.select(F.col("uuid").alias("uuid_lab"), "uuid_analyte", F.col("units").alias("_from"))
    a = analyte.select(F.col("uuid").alias("uuid_analyte"), F.col("units").alias("_to"))
    rows = analysis.join(m, "uuid_lab").join(a, "uuid_analyte").join(done.select("uuid").distinct(), "uuid", "left_anti")
    new = {c: units.convert(F.col(c), F.col("_from"), F.col("_to")) for c in ("value", "rl_low")}
    same = F.col("_from").eqNullSafe(F.col("_to"))
    bad = new["value"]["error"].isNotNull() | F.col("_from").isNull() | F.col("_to").isNull()
    status = F.when(same, "same_unit").when(bad, "incompatible").otherwise("converted")
    pick = lambda c: F.when(same, F.col(c)).when(~bad, new[c]["value"])
    return rows.select("uuid", pick("value").alias("value"), pick("rl_low").alias("rl_low"), status.alias("status"))


def convert_analyses(store: Store, uuid_lab: str, actor: str) -> dict[str, int]:
    """Convert a confirmed method's stored analyses to its analyte's unit, once: analyses by status.

    The change log marks what is done, so another call changes nothing; if one can't be converted none is.
    """
    reason = "converted to the analyte's unit"
    with store.transaction():
        done = store.read("change_log").where((F.col("tbl") == "analysis") & (F.col("reason") == reason)).select(F.col("uuid_row").alias("uuid"))
        method = store.read("lab_method").where(F.col("uuid") == uuid_lab)
        out = written(converted_analyses(store.read("analysis"), method, store.read("analyte"), done), "registry-converted")
        counts = {r.status: r["count"] for r in out.groupBy("status").count().collect()}
        if "incompatible" not in counts and counts.get("converted"):
            store.update("analysis", out.where("status = 'converted'").drop("status"), actor, reason)
        return counts


def reported_as(methods: DataFrame) -> DataFrame:
    """What backfilling the form that methods (uuid, name, reported_as) report would do: uuid, reported_as, status.

    filled: the name states it and none is stored. kept: it is stored alike. conflict: another is stored.
    """
    found = text.reported_as(F.col("name"))
    status = F.when(F.col("reported_as").isNull(), "filled").when(F.col("reported_as") == found, "kept").otherwise("conflict")
    return methods.where(found.isNotNull()).select("uuid", F.coalesce("reported_as", found).alias("reported_as"), status.alias("status"))


def skip_rows(rows: DataFrame) -> DataFrame:
    """Records of skipped rows: source_ref, reason, source_hash, existing_uuid, kept_uuid_lab, payload of what is known."""
    facts = F.to_json(F.struct(F.col("e_uuid").alias("existing_uuid"), "kept_uuid_lab", "twin"))
    return rows.where("disposition = 'skipped'").select("source_ref", "reason", "source_hash", F.col("e_uuid").alias("existing_uuid"), "kept_uuid_lab", facts.alias("payload"))


def write_report(statistics: DataFrame, path: str, censored: tuple[str, ...] = ()) -> None:
    """A compliance report as one CSV file with a header; each censored column has a `_nd` flag beside it.

    The rows are statistics of features and analytes, so one file holds them.
    """
    flags = [F.col(f"{c}_nd") if f"{c}_nd" in statistics.columns else F.lit(False).alias(f"{c}_nd") for c in censored]
    columns = [c for c in statistics.columns if not c.endswith("_nd")]
    statistics.select(*columns, *flags).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
