"""Confirmations: what a person decides about unknown points and methods, carried out on a store.

A batch of decisions is one plan and one transaction: it is done whole or, if one decision
can't stand, not at all. Nothing is decided row by row: what several decisions do to one
visit is settled by the least sample, and chains of merges are followed to their ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, values
from ..functions.dates import require_dates
from ..operators import commit
from ..operators.joins import first_by
from .ingest import made, shaped
from .registry import converted_analyses
from .scratch import written
from .store import Store

CONVERTED = "converted to the analyte's unit"


def refuse(bad: DataFrame, what: str) -> None:
    """Raise ValueError naming a few rows, if there are any."""
    some = bad.limit(5).collect()
    if some:
        raise ValueError(f"{what}: {[tuple(r) for r in some]}")


def closed(moves: DataFrame) -> DataFrame:
    """moves (old, new), each followed to its end: pointer jumping, so a chain of n takes log n rounds. Cycles and forks are refused."""
    refuse(moves.groupBy("old").agg(F.countDistinct("new").alias("n")).where("n > 1"), "moved to several places")
    now = written(moves.where("old <> new").select("old", "new").distinct(), "confirm-moves")
    refuse(moves.where("old = new"), "moved to themselves")
    n = now.count()
    for _ in range(n.bit_length() + 1):
        far = now.select(F.col("old").alias("new"), F.col("new").alias("_far"))
        hop = written(now.join(far, "new", "left").select("old", F.coalesce("_far", "new").alias("new"), F.col("_far").isNotNull().alias("_moved")), "confirm-moves")
        now = hop.select("old", "new")
        if hop.where("_moved").isEmpty():
            return now
    refuse(now.join(now.select(F.col("old").alias("new")), "new", "left_semi"), "moved in a circle")
    return now


def _set(store: Store, table: str, changes: DataFrame, actor: str, reason: str) -> None:
    changes = written(changes, "confirm-changes")
    if not changes.isEmpty():
        store.update(table, changes, actor, reason)


def _drop(store: Store, table: str, uuids: DataFrame, actor: str, reason: str) -> None:
    uuids = written(uuids.select("uuid"), "confirm-gone")
    if not uuids.isEmpty():
        store.delete(table, uuids, actor, reason)


def _repoint(store: Store, table: str, column: str, moves: DataFrame, actor: str, reason: str) -> None:
    """Rows of a table whose column holds an old id get the new one."""
    rows = store.read(table).join(moves.withColumnRenamed("old", column), column)
    _set(store, table, rows.select("uuid", F.col("new").alias(column)), actor, reason)


def _ask(store: Store, questions: DataFrame, actor: str) -> None:
    """Open questions (kind, subkind, uuid_target, uuid_existing, payload) that aren't open yet."""
    rows = questions.withColumn("uuid", made("rq-", "kind", "subkind", "uuid_target", "payload")).dropDuplicates(["uuid"])
    rows = written(rows.join(store.read("review_queue").select("uuid"), "uuid", "left_anti").withColumn("status", F.lit("open")), "confirm-questions")
    if not rows.isEmpty():
        store.append("review_queue", shaped(rows, "review_queue"), actor, "question of a confirmation")


def _answer(store: Store, kind: str, answered: DataFrame, actor: str) -> None:
    """Close the open questions of a kind about things (uuid, key): by their target, or by the key in their payload."""
    open_ = store.read("review_queue").where((F.col("kind") == kind) & (F.col("status") == "open"))
    key = F.get_json_object("payload", "$.key")
    hit = open_.join(answered.select(F.col("uuid").alias("uuid_target")), "uuid_target", "left_semi").select("uuid")
    hit = hit.union(open_.withColumn("key", key).join(answered.where("key is not null").select("key"), "key", "left_semi").select("uuid")).distinct()
    _set(store, "review_queue", hit.select("uuid", F.lit("closed").alias("status"), F.lit("confirmed").alias("resolution"), F.lit(actor).alias("resolved_by")), actor, "confirmed")


def merge_samples(store: Store, moves: DataFrame, actor: str) -> DataFrame:
    """Merge samples into others: moves (old, new), in chains or not. Returns what became of each analysis: uuid, action.

    Of a winner's analyses by one method the least of its own (else the least that comes)
    stands. Others that are equal to it go (drop_equal); different ones come too and a question asks about
    them (review); those of other methods come (repoint). The losers go, with their instants in the log.
    """
    with store.transaction():
        m = closed(moves)
        sample = store.read("sample")
        ids = m.select(F.col("old").alias("uuid")).union(m.select(F.col("new").alias("uuid"))).distinct()
        refuse(ids.join(sample.select("uuid"), "uuid", "left_anti"), "no such sample")
        analysis = store.read("analysis")
        comes = analysis.join(m.withColumnRenamed("old", "uuid_sample"), "uuid_sample").select(*analysis.columns, F.col("new").alias("_to"), F.lit(True).alias("_comes"))
        own = analysis.join(m.select(F.col("new").alias("uuid_sample")).distinct(), "uuid_sample", "left_semi").select(*analysis.columns, F.col("uuid_sample").alias("_to"), F.lit(False).alias("_comes"))
        every = written(comes.union(own), "confirm-analyses")
        base = first_by(every.where("uuid_lab is not null"), ["_to", "uuid_lab"], [F.col("_comes"), F.col("uuid")])
        base = base.select("_to", "uuid_lab", F.col("uuid").alias("_base"), *[F.col(c).alias(f"_b_{c}") for c in ("value", "value_chr", "quantified")])
        same = values.values_equal(F.col("value"), F.col("value_chr"), F.col("quantified"), F.col("_b_value"), F.col("_b_value_chr"), F.col("_b_quantified"))
        alone = F.col("_base").isNull() | (F.col("_base") == F.col("uuid"))
        done = every.where("_comes").join(base, ["_to", "uuid_lab"], "left").withColumn("action", F.when(alone, "repoint").when(same, "drop_equal").otherwise("review"))
        done = written(done, "confirm-merged")
        _drop(store, "analysis", done.where("action = 'drop_equal'"), actor, "merge: duplicate analysis dropped")
        _set(store, "analysis", done.where("action <> 'drop_equal'").select("uuid", F.col("_to").alias("uuid_sample")), actor, "merge: moved to the sample that stays")
        facts = F.to_json(F.struct(F.col("_base").alias("uuid_existing"), F.col("uuid").alias("uuid_incoming"), F.col("_b_value").alias("value_existing"), F.col("value").alias("value_incoming")))
        asked = done.where("action = 'review'").select(F.lit("value_conflict").alias("kind"), F.lit("alias_merge").alias("subkind"), F.lit(None).cast("string").alias("uuid_target"), F.col("_base").alias("uuid_existing"), facts.alias("payload"))
        _ask(store, asked, actor)
        _repoint(store, "resolution", "uuid_sample", m, actor, "merge: sample merged")
        stays = sample.select(F.col("uuid").alias("new"), F.col("datetime").cast("string").alias("_new"))
        lost = sample.select(F.col("uuid").alias("old"), F.col("datetime").cast("string").alias("_old")).join(m, "old").join(stays, "new").where("not _old <=> _new")
        lost = written(lost.select(F.col("old").alias("uuid"), F.lit("datetime").alias("field"), F.col("_old").alias("old"), F.col("_new").alias("new")), "confirm-lost")
        store._log(lost, "sample", "provenance", actor, "merge: instant discarded", None)
        _drop(store, "sample", m.select(F.col("old").alias("uuid")), actor, "merge: emptied sample deleted")
        return done.select("uuid", "action")


def _losers(sample: DataFrame, alias: DataFrame, new: DataFrame) -> DataFrame:
    """Samples that meet others once aliases (uuid_alias, uuid_feature) are linked: old, new (the one that stays), uuid_feature, date.

    At a point and day the least sample of an alias linked before stands, else the least of all; samples of
    that alias meet nothing.
    """
    linked = alias.select(F.col("uuid").alias("uuid_feature_alias"), F.col("uuid_feature").alias("_was")).join(
        new.select(F.col("uuid_alias").alias("uuid_feature_alias"), F.col("uuid_feature").alias("_now")), "uuid_feature_alias", "left"
    )
    s = sample.where("date is not null").join(linked, "uuid_feature_alias").withColumn("at", F.coalesce("_now", "_was")).where("at is not null")
    s = s.join(new.select(F.col("uuid_feature").alias("at")).distinct(), "at", "left_semi")
    fresh = F.col("_now").isNotNull() & ~F.col("_was").eqNullSafe(F.col("_now"))
    s = s.select("uuid", "at", "date", "uuid_feature_alias", fresh.alias("fresh"))
    best = s.groupBy("at", "date").agg(F.min_by(F.struct("uuid", "uuid_feature_alias"), F.struct("fresh", "uuid")).alias("best"))
    met = s.join(best, ["at", "date"]).where("fresh").where(F.col("uuid_feature_alias") != F.col("best.uuid_feature_alias"))
    return met.select(F.col("uuid").alias("old"), F.col("best.uuid").alias("new"), F.col("at").alias("uuid_feature"), "date")


def confirm_aliases(store: Store, requests: DataFrame, actor: str, override: bool = False) -> DataFrame:
    """Link aliases to points: requests has uuid_alias, uuid_feature and perhaps kind, date_start, date_end.

    An alias that is the point's own name becomes its own alias, or, if there is one already, goes: its
    samples, provenance and open questions move to that one (self_arm). Samples that then meet others of the point's on
    the same day are refused, or with override merged into them. Several samples of one alias on a day
    raise a question. Open questions about the aliases are closed. Without a point only
    dates change. Refused, with nothing changed: unknown ids, an alias twice, one that
    is linked elsewhere, dates on an own name or the wrong way round.
    Returns uuid_alias, uuid_feature, n_samples, action (confirmed, self_arm, merged, bounds_updated).
    """
    with store.transaction():
        alias, feature = store.read("feature_alias"), store.read("feature")
        types = {"uuid_alias": "string", "uuid_feature": "string", "kind": "string", "date_start": "date", "date_end": "date"}
        require_dates(requests, *[c for c in ("date_start", "date_end") if c in requests.columns])
        asked = requests.select(*[(F.col(c) if c in requests.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
        refuse(asked.groupBy("uuid_alias").count().where("count > 1").select("uuid_alias"), "aliases named twice")
        refuse(asked.where("date_start > date_end").select("uuid_alias"), "dates the wrong way round")
        a = alias.select(F.col("uuid").alias("uuid_alias"), "alias_key", F.col("kind").alias("_kind"), F.col("uuid_feature").alias("_was"))
        f = feature.select(F.col("uuid").alias("uuid_feature"), text.feature_key(F.col("name")).alias("_name"))
        refuse(asked.join(a, "uuid_alias", "left_anti").select("uuid_alias"), "no such alias")
        refuse(asked.where("uuid_feature is not null").join(f, "uuid_feature", "left_anti").select("uuid_feature"), "no such point")
        rows = asked.join(a, "uuid_alias").withColumn("_only_dates", F.col("uuid_feature").isNull()).withColumn("uuid_feature", F.coalesce("uuid_feature", "_was")).join(f, "uuid_feature", "left")
        refuse(rows.where("_was <> uuid_feature").select("uuid_alias", "_was", "uuid_feature"), "linked to another point")
        own = alias.where("kind = 'self'").groupBy(F.col("uuid_feature").alias("uuid_feature"), F.col("alias_key").alias("_name")).agg(F.min("uuid").alias("_own"))
        rows = rows.join(own, ["uuid_feature", "_name"], "left")
        named = values.is_true(F.col("alias_key") == F.col("_name"))
        dated = F.col("date_start").isNotNull() | F.col("date_end").isNotNull()
        rows = rows.withColumn("_named", named).withColumn("_arm", F.when(named & (F.col("_own") != F.col("uuid_alias")), F.col("_own"))).withColumn("_dated", dated)
        rows = written(rows, "confirm-aliases")
        refuse(rows.where("_only_dates and (not _dated or kind is not null)").select("uuid_alias"), "nothing to do")
        refuse(rows.where("_dated and (_named or _kind = 'self')").select("uuid_alias"), "an own name has no dates")
        refuse(rows.where("_named and kind is not null").select("uuid_alias"), "an own name has its kind")

        sample = store.read("sample")
        n = sample.groupBy(F.col("uuid_feature_alias").alias("uuid_alias")).agg(F.count("*").alias("n_samples"))
        meet = written(_losers(sample, alias, rows.where("not _only_dates")), "confirm-collisions")
        if not override:
            refuse(meet.select("uuid_feature", "date", "new", "old"), "samples collide")
        merged = meet.select(F.col("old").alias("uuid")).join(sample.select("uuid", F.col("uuid_feature_alias").alias("uuid_alias")), "uuid").select("uuid_alias").distinct()
        action = F.when(F.col("_only_dates"), "bounds_updated").when(F.col("_met"), "merged").when(F.col("_arm").isNotNull(), "self_arm").otherwise("confirmed")
        out = rows.join(n, "uuid_alias", "left").join(merged.withColumn("_met", F.lit(True)), "uuid_alias", "left")
        out = written(out.select("uuid_alias", "uuid_feature", F.coalesce("n_samples", F.lit(0)).alias("n_samples"), action.alias("action")), "confirm-done")

        several = sample.join(rows.where("not _only_dates").select(F.col("uuid_alias").alias("uuid_feature_alias"), "uuid_feature"), "uuid_feature_alias").where("date is not null")
        least = several.groupBy("uuid_feature_alias", "date").agg(F.min("uuid").alias("_a"))
        pairs = several.join(least, ["uuid_feature_alias", "date"]).where("uuid <> _a")  # each with the least: no more than samples
        facts = F.to_json(F.struct("uuid_feature", F.col("date").cast("string").alias("collision_date"), F.col("_a").alias("uuid_sample_a"), F.col("uuid").alias("uuid_sample_b")))
        none = F.lit(None).cast("string").alias("uuid_existing")
        _ask(store, pairs.select(F.lit("sample_collision").alias("kind"), F.lit("same_alias").alias("subkind"), F.col("uuid_feature_alias").alias("uuid_target"), none, facts.alias("payload")), actor)

        kind = F.when(F.col("_named"), "self").when(F.col("kind").isNotNull(), F.col("kind")).when(F.col("_kind") == "pending", "transcription_error").otherwise(F.col("_kind"))
        stay = rows.where("_arm is null and not _only_dates").join(alias.select(F.col("uuid").alias("uuid_alias"), F.col("date_start").alias("_s"), F.col("date_end").alias("_e")), "uuid_alias")
        _set(store, "feature_alias", stay.select(F.col("uuid_alias").alias("uuid"), "uuid_feature", F.lit(True).alias("auto_assign"), kind.alias("kind"), F.when(~F.col("_named"), F.coalesce("date_start", "_s")).alias("date_start"), F.when(~F.col("_named"), F.coalesce("date_end", "_e")).alias("date_end")), actor, "confirmed")
        dates = rows.where("_only_dates").join(alias.select(F.col("uuid").alias("uuid_alias"), F.col("date_start").alias("_s"), F.col("date_end").alias("_e")), "uuid_alias")
        _set(store, "feature_alias", dates.select(F.col("uuid_alias").alias("uuid"), F.coalesce("date_start", "_s").alias("date_start"), F.coalesce("date_end", "_e").alias("date_end")), actor, "dates of validity")
        if not meet.isEmpty():
            merge_samples(store, meet.select("old", "new"), actor)
        moves = rows.where("_arm is not null").select(F.col("uuid_alias").alias("old"), F.col("_arm").alias("new"))
        if not moves.isEmpty():
            moves = closed(moves)
            _repoint(store, "sample", "uuid_feature_alias", moves, actor, "moved to the point's own alias")
            _repoint(store, "resolution", "uuid_alias", moves, actor, "moved to the point's own alias")
            _repoint(store, "review_queue", "uuid_target", moves, actor, "moved to the point's own alias")
            _drop(store, "feature_alias", moves.select(F.col("old").alias("uuid")), actor, "its point has an own alias")
        _answer(store, "unknown_feature", rows.where("not _only_dates").select(F.coalesce("_arm", "uuid_alias").alias("uuid"), F.col("alias_key").alias("key")), actor)
        return out


def confirm_methods(store: Store, requests: DataFrame, actor: str) -> DataFrame:
    """Link laboratory methods to analytes (uuid_lab, uuid_analyte) and convert their stored analyses, once, to the analytes' units.

    Refused, with nothing changed: unknown ids, a method twice, one linked to another analyte, one whose
    recorded unit has changed. Analyses that can't be converted stay and a question asks about each.
    Open questions about the methods are closed. Returns uuid_lab, uuid_analyte, status, n_converted, n_unknown.
    """
    with store.transaction():
        method, analyte, log = store.read("lab_method"), store.read("analyte"), store.read("change_log")
        asked = requests.select("uuid_lab", "uuid_analyte")
        refuse(asked.groupBy("uuid_lab").count().where("count > 1").select("uuid_lab"), "methods named twice")
        refuse(asked.join(analyte.select(F.col("uuid").alias("uuid_analyte")), "uuid_analyte", "left_anti"), "no such analyte")
        units = log.where("tbl = 'lab_method' and field = 'units'")
        units = units.select(F.col("uuid_row").alias("uuid_lab"), F.explode(F.array("old", "new")).alias("units"))
        judged = written(commit.confirm_methods(asked, method, units), "confirm-methods")
        refuse(judged.where("status not in ('confirmed', 'already_confirmed')"), "methods that can't be confirmed")
        _set(store, "lab_method", judged.where("status = 'confirmed'").select(F.col("uuid_lab").alias("uuid"), "uuid_analyte"), actor, "confirmed")

        mine = store.read("lab_method").join(judged.select(F.col("uuid_lab").alias("uuid")), "uuid", "left_semi")
        done = log.where((F.col("tbl") == "analysis") & (F.col("reason") == CONVERTED)).select(F.col("uuid_row").alias("uuid"))
        new = converted_analyses(store.read("analysis"), mine, analyte, done).join(store.read("analysis").select("uuid", "uuid_lab"), "uuid")
        new = written(new, "confirm-converted")
        _set(store, "analysis", new.where("status = 'converted'").select("uuid", "value", "rl_low"), actor, CONVERTED)
        bad = new.where("status = 'incompatible'").join(mine.select(F.col("uuid").alias("uuid_lab"), F.col("units").alias("units_from"), "uuid_analyte"), "uuid_lab")
        bad = bad.join(analyte.select(F.col("uuid").alias("uuid_analyte"), F.col("units").alias("units_to")), "uuid_analyte")
        facts = F.to_json(F.struct(F.col("uuid").alias("uuid_analysis"), "uuid_lab", "units_from", "units_to"))
        none = F.lit(None).cast("string")
        _ask(store, bad.select(F.lit("unknown_unit").alias("kind"), none.alias("subkind"), F.col("uuid").alias("uuid_target"), none.alias("uuid_existing"), facts.alias("payload")), actor)
        key = F.concat_ws("|", "organisation", text.method_key(F.col("name")), F.coalesce(text.method_key(F.col("method")), F.lit("")))
        _answer(store, "unknown_analyte", mine.select("uuid", key.alias("key")), actor)
        n = new.groupBy("uuid_lab").agg(F.count_if(F.col("status") == "converted").alias("n_converted"), F.count_if(F.col("status") == "incompatible").alias("n_unknown"))
        return judged.join(n, "uuid_lab", "left").fillna({"n_converted": 0, "n_unknown": 0})
