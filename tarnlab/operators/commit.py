"""Commit of reconciled events as sets: materialised registry rows, guards, project trees, provenance and confirmations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, values
from .joins import first_by


def materialise_aliases(pending: DataFrame, alias: DataFrame) -> DataFrame:
    """The dangling alias of each pending key: the least existing one with more sightings, or a new one.

    pending: alias_key, name, date, datetime. Sightings are distinct (date, datetime). A new alias
    holds from the first date of all its rows, in whatever order they come. A stored bound stays as it is,
    earlier dates or not: only a confirmation moves it.
    Returns alias_key, uuid, n_seen, date_start, is_new.
    """
    g = pending.where("alias_key is not null").groupBy("alias_key").agg(
        F.countDistinct(F.struct("date", "datetime")).alias("n"), F.min("date").alias("date_start")
    )
    first = F.col("date_start") if "date_start" in alias.columns else F.lit(None).cast("date").alias("date_start")
    old = alias.where("uuid_feature is null").groupBy(F.col("alias_key").alias("_k")).agg(F.min(F.struct(F.col("uuid"), F.col("n_seen"), first)).alias("_o"))
    out = g.join(old, F.col("alias_key") == F.col("_k"), "left")
    made = F.concat(F.lit("fa-"), F.substring(F.sha2("alias_key", 256), 1, 16))
    return out.select(
        "alias_key", F.coalesce("_o.uuid", made).alias("uuid"), (F.col("n") + F.coalesce("_o.n_seen", F.lit(0))).alias("n_seen"), F.when(F.col("_o").isNull(), F.col("date_start")).otherwise(F.col("_o.date_start")).alias("date_start"),
        F.col("_o").isNull().alias("is_new"),
    )


def materialise_methods(rows: DataFrame, method: DataFrame) -> DataFrame:
    """The dangling method of each (organisation, folded name, folded method): reused or new; drifted if its unit changes.

    rows: org, analyte_raw, method_raw, units.
    """
    keys = [F.col("org"), text.method_key(F.col("analyte_raw")).alias("name_key"), text.method_key(F.col("method_raw")).alias("meth_key")]
    g = rows.select(*keys, "units").where("name_key is not null and org is not null").groupBy("org", "name_key", "meth_key").agg(F.min("units").alias("units"), F.count("*").alias("n_rows"))
    old = method.where("uuid_analyte is null").select(
        F.col("organisation").alias("_org"), text.method_key(F.col("name")).alias("_n"), text.method_key(F.col("method")).alias("_m"), F.col("uuid").alias("_uuid"), F.col("units").alias("_units")
    )
    old = first_by(old, ["_org", "_n", "_m"], [F.col("_uuid")])
    out = g.join(old, (F.col("org") == F.col("_org")) & (F.col("name_key") == F.col("_n")) & F.col("meth_key").eqNullSafe(F.col("_m")), "left")
    drift = F.col("_uuid").isNotNull() & F.col("units").isNotNull() & ~F.col("units").eqNullSafe(F.col("_units"))
    return out.select("org", "name_key", "meth_key", "n_rows", F.col("_uuid").alias("uuid"), F.col("_uuid").isNull().alias("is_new"), drift.alias("drifted"))


def units_sightings(rows: DataFrame, method: DataFrame) -> DataFrame:
    """The unit in which each known method without an analyte comes now, where it is another than recorded.

    rows: row, uuid_lab, units_raw, source_hash; the first row of each method speaks. Without
    a unit it says nothing; a method without a recorded one differs from any. Returns uuid, field, old, new, source_hash.
    """
    first = first_by(rows.where("uuid_lab is not null").select("uuid_lab", "row", "units_raw", "source_hash"), ["uuid_lab"], [F.col("row")])
    old = method.where("uuid_analyte is null").select(F.col("uuid").alias("uuid_lab"), F.col("units").alias("old"))
    out = first.join(old, "uuid_lab").where("units_raw is not null and not units_raw <=> old")
    return out.select(F.col("uuid_lab").alias("uuid"), F.lit("units").alias("field"), "old", F.col("units_raw").alias("new"), "source_hash")


def recorded_revisions(recorded: DataFrame, guessed: DataFrame, own: DataFrame) -> DataFrame:
    """Greatest revision known of each work order, from records and file names, own files left out: work_order, revision."""
    both = recorded.select("work_order", "hash", "revision").union(guessed.select("work_order", "hash", "revision"))
    return both.join(own.select("hash").distinct(), "hash", "left_anti").groupBy("work_order").agg(F.max("revision").alias("revision"))


def reingest_guard(orders: DataFrame) -> DataFrame:
    """Adds decision to work orders (n_samples, n_prior_assets, incoming_revision, recorded_revision, n_unmatched).

    Without prior samples and foreign files all is new. A higher revision, or rows that
    all match what is there, pass; anything else is blocked for review.
    """
    return orders.withColumn(
        "decision",
        F.when((F.col("n_samples") == 0) | (F.col("n_prior_assets") == 0), "new")
        .when(values.is_true(F.col("incoming_revision") > F.col("recorded_revision")), "higher_revision")
        .when(F.col("n_unmatched") == 0, "all_match")
        .otherwise("blocked"),
    )


def project_roots(project: DataFrame) -> DataFrame:
    """Adds root_of: the recorded root, else the parent, else the project itself."""
    return project.withColumn("root_of", F.coalesce("uuid_root", "uuid_parent", "uuid"))


def project_chains(project: DataFrame) -> DataFrame:
    """Each project with its parent and grandparent (a forest of campaign, report and work order)."""
    up = project.select(F.col("uuid").alias("p1"), F.col("name").alias("parent"), F.col("uuid_parent").alias("p2"))
    top = project.select(F.col("uuid").alias("p3"), F.col("name").alias("grandparent"))
    return project.join(up, F.col("uuid_parent") == F.col("p1"), "left").join(top, F.col("p2") == F.col("p3"), "left").select("uuid", "name", "parent", "grandparent")


def adopted_parents(children: DataFrame, project: DataFrame) -> DataFrame:
    """The parent to give each report (report, work_order): that of its work orders if they agree on one; else why not.

    A report that has a parent keeps it; another one is a conflict.
    """
    wo = project.select(F.col("name").alias("work_order"), F.col("uuid_parent").alias("_up"))
    have = project.select(F.col("name").alias("report"), F.col("uuid_parent").alias("_own"))
    g = children.join(wo, "work_order", "left").groupBy("report").agg(F.collect_set("_up").alias("_ups")).join(have, "report", "left")
    one = F.when(F.size("_ups") == 1, F.col("_ups")[0])
    status = (
        F.when(F.size("_ups") == 0, "none").when(F.size("_ups") > 1, "ambiguous").when(F.col("_own").isNull(), "adopted")
        .when(F.col("_own") == one, "kept").otherwise("project_parent_conflict")
    )
    return g.select("report", F.coalesce("_own", one).alias("uuid_parent"), status.alias("status"))


def resolution_provenance(clean: DataFrame) -> DataFrame:
    """Each (sample, alias, resolution) once, with how many rows it stands for."""
    return clean.where("resolution is not null").groupBy("uuid_sample", "uuid_alias", "resolution").agg(F.count("*").alias("n_rows"))


def deletions(supersede: DataFrame, analysis: DataFrame) -> DataFrame:
    """Analyses to delete that still exist, each once."""
    return analysis.join(supersede.select(F.col("uuid_analysis").alias("uuid")).distinct(), "uuid", "left_semi")


def confirm_aliases(requests: DataFrame, alias: DataFrame, feature: DataFrame, colliding: DataFrame) -> DataFrame:
    """What a confirmation does: requests (uuid_alias, uuid_feature, override, date_start, date_end) with action.

    unknown: no such alias or feature. self_arm: the alias is the feature's own name and it
    has no own alias yet. merged: it has one. bounds_updated: already linked, only dates change;
    confirmed: linked now (or already). collision: samples collide and override isn't set.
    """
    a = alias.select(F.col("uuid").alias("uuid_alias"), "alias_key", "kind", F.col("uuid_feature").alias("_linked"))
    f = feature.select(F.col("uuid").alias("uuid_feature"), F.lower("name").alias("_fold"))
    own = alias.where("kind = 'self'").groupBy(F.col("uuid_feature").alias("_of")).agg(F.min("uuid").alias("_own"))
    hit = colliding.select("uuid_alias", "uuid_feature").distinct().withColumn("_collides", F.lit(True))
    out = requests.join(a, "uuid_alias", "left").join(f, "uuid_feature", "left").join(own, F.col("uuid_feature") == F.col("_of"), "left")
    out = out.join(hit, ["uuid_alias", "uuid_feature"], "left")
    named = values.is_true(F.col("alias_key") == F.col("_fold"))
    bounds = F.col("date_start").isNotNull() | F.col("date_end").isNotNull()
    linked = values.is_true(F.col("_linked") == F.col("uuid_feature"))
    action = (
        F.when(F.col("alias_key").isNull() | F.col("_fold").isNull(), "unknown")
        .when(linked & bounds, "bounds_updated")
        .when(linked, "confirmed")
        .when(values.is_true(F.col("_collides")) & ~values.is_true(F.col("override")), "collision")
        .when(named & F.col("_own").isNotNull(), "merged")
        .when(named, "self_arm")
        .otherwise("confirmed")
    )
    return out.withColumn("action", action).select("uuid_alias", "uuid_feature", "action")


def confirm_methods(requests: DataFrame, method: DataFrame, recorded: DataFrame) -> DataFrame:
    """What confirming a method's analyte does: requests (uuid_lab, uuid_analyte) with status.

    recorded: uuid_lab, units of every unit ever seen; several drift and block.
    """
    m = method.select(F.col("uuid").alias("uuid_lab"), F.col("uuid_analyte").alias("_linked"), F.lit(True).alias("_known"))
    n = recorded.where("units is not null").groupBy("uuid_lab").agg(F.countDistinct("units").alias("_units"))
    out = requests.join(m, "uuid_lab", "left").join(n, "uuid_lab", "left")
    status = (
        F.when(F.col("_known").isNull(), "unknown").when(F.col("_linked") == F.col("uuid_analyte"), "already_confirmed")
        .when(F.col("_linked").isNotNull(), "repoint_refused").when(F.col("_units") > 1, "units_drift").otherwise("confirmed")
    )
    return out.select("uuid_lab", "uuid_analyte", status.alias("status"))


def repointed(rows: DataFrame, column: str, moves: DataFrame) -> DataFrame:
    """rows with column moved along (old, new); others stay."""
    m = moves.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    return rows.join(m, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def torn_updates(log: DataFrame) -> DataFrame:
    """Tables and fields that were detached more often than attached again."""
    g = log.groupBy("tbl", "field").agg(
        F.count_if(F.col("reason").like("detach%")).alias("n_detached"), F.count_if(F.col("reason").like("reattach%")).alias("n_attached")
    )
    return g.where("n_detached > n_attached")


def mapping_faults(mapping: DataFrame) -> DataFrame:
    """Faults of a mapping (name, uuid_analyte, constant) and how many rows each has."""
    fold = text.method_key(F.col("name"))
    m = mapping.withColumn("_fold", fold)
    per_name = m.groupBy("name").agg(F.count("*").alias("n"))
    per_fold = m.where("_fold is not null").groupBy("_fold").agg(F.countDistinct("uuid_analyte").alias("k"))
    one = m.agg(
        F.count_if(F.coalesce(F.trim("name") == "", F.lit(True))).alias("blank_name"),
        F.count_if(F.col("name") != F.trim("name")).alias("untrimmed_name"),
        F.count_if(F.col("constant") <= 0).alias("bad_constant"),
    )
    faults = one.select(F.stack(F.lit(3), *[x for c in one.columns for x in (F.lit(c), F.col(c))]).alias("fault", "n"))
    faults = faults.union(per_name.where("n > 1").agg(F.lit("duplicate_name"), F.count("*")))
    return faults.union(per_fold.where("k > 1").agg(F.lit("fold_of_several_analytes"), F.count("*")))


def cas_suggestions(misses: DataFrame, analyte: DataFrame) -> DataFrame:
    """Analytes that rows without a method (row, cas_number) may mean: the least with the CAS number."""
    a = analyte.where("cas is not null").groupBy(F.col("cas").alias("cas_number")).agg(F.min("uuid").alias("suggested"))
    return misses.where("cas_number is not null").join(a, "cas_number").select("row", "suggested")


def corrected(analysis: DataFrame, corrections: DataFrame) -> DataFrame:
    """Manual corrections (uuid, new_value): value and flag anew; text rows are refused. Adds status."""
    out = analysis.join(corrections, "uuid", "left")
    refuse = F.col("new_value").isNotNull() & F.col("value_chr").isNotNull()
    change = F.col("new_value").isNotNull() & ~refuse
    return (
        out.withColumn("status", F.when(refuse, "refused").when(change, "corrected").otherwise("unchanged"))
        .withColumn("quantified", F.when(change, values.corrected_flag(F.col("new_value"), F.col("rl_low"), F.lit(None).cast("double"))).otherwise(F.col("quantified")))
        .withColumn("value", F.when(change, F.col("new_value")).otherwise(F.col("value")))
        .drop("new_value")
    )


def checks(named: Mapping[str, DataFrame]) -> DataFrame:
    """A battery of checks: each DataFrame holds offending rows; a row with count and verdict of each, in one query."""
    out = None
    for name, df in named.items():
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("n_bad")).withColumn("passed", F.col("n_bad") == 0)
        out = row if out is None else out.union(row)
    return out


def missing_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """df with the typed columns it lacks, null."""
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns])


def validate(df: DataFrame, required: list[str], vocabulary: Mapping[str, tuple[str, ...]], not_negative: list[str]) -> DataFrame:
    """Violations of a table's rules, counted in one pass: rule, n."""
    rules: dict[str, Column] = {f"null:{c}": F.col(c).isNull() for c in required}
    rules |= {f"vocabulary:{c}": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in vocabulary.items()}
    rules |= {f"negative:{c}": F.col(c) < 0 for c in not_negative}
    one = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"_{i}") for i, bad in enumerate(rules.values())])
    pairs = [x for i, name in enumerate(rules) for x in (F.lit(name), F.col(f"_{i}"))]
    return one.select(F.stack(F.lit(len(rules)), *pairs).alias("rule", "n"))
