"""Ingest: a folder of files is routed, parsed, assembled, reconciled and committed in one call.

Events that share a point and day, or a work order, go in turns, each of which sees what the
earlier ones committed; all events of a turn are one distributed batch and one transaction.
An event that fails is left out and the others commit.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values
from ..operators import assemble as asm
from ..operators import commit, event, samples
from ..operators.joins import first_by
from ..sources import adapters
from ..sources import files as src
from . import archive
from .scratch import written
from .store import Conflict, Store, commit_outcomes, find_or_create

#: Tables of a store and their columns.
SCHEMA = {
    "feature": "uuid string, name string, site string, lon double, lat double, flow string, matrix string, geom_wkt string, virtual boolean, date_end date",
    "feature_alias": "uuid string, uuid_feature string, alias_key string, name string, kind string, auto_assign boolean, date_start date, date_end date, n_seen long, comments string",
    "analyte": "uuid string, name string, units string, conversion_constant double, type string, cas string",
    "lab_method": "uuid string, uuid_analyte string, name string, method string, organisation string, units string, rl_low double, preference int, conversion_constant double",
    "project": "uuid string, uuid_parent string, uuid_root string, name string, type string, purpose string, site string",
    "sample": "uuid string, uuid_feature_alias string, date date, datetime timestamp_ntz, uuid_project string",
    "analysis": "uuid string, uuid_sample string, uuid_lab string, value double, rl_low double, value_chr string, quantified boolean, revision int",
    "ingest_file": "uuid string, hash string, filename string, work_order string, revision int, adapter string, state string, reason string",
    "review_queue": "uuid string, kind string, subkind string, status string, work_order string, source_hash string, source_ref string, uuid_existing string, uuid_target string, payload string, resolution string, resolved_by string",
    "review_queue_candidate": "uuid string, uuid_review string, rank int, uuid_feature string",
    "resolution": "uuid string, uuid_sample string, uuid_alias string, resolution string, n_rows long",
    "seen_again": "uuid string, uuid_analysis string, source_hash string, source_ref string",
    "asset": "uuid string, hash string, filename string, type string, uuid_project string",
    "archive": "uuid string, hash string, content binary",
    "ingest_sighting": "uuid string, hash string, path string",
    "ingest_batch": "uuid string, n_files long",
}
TERMINAL = ("archived", "committed", "ignored")


def ensure_schema(store: Store) -> None:
    """Create the tables that a store lacks, empty."""
    missing = [n for n in SCHEMA if not store.exists(n)]
    if missing:
        with store.transaction():
            for name in missing:
                store.create(name, SCHEMA[name])


def shaped(df: DataFrame, table: str) -> DataFrame:
    """df with exactly the columns of a table; those it lacks are null."""
    have = set(df.columns)
    parts = [p.split() for p in SCHEMA[table].split(", ")]
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in parts])


def made(prefix: str, *columns: str):
    """An id derived from what it stands for, so a retry makes the same one."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256), 1, 32))


def current_states(hashes: DataFrame, ingest_file: DataFrame) -> DataFrame:
    """The stored state of each hash, null if it isn't known."""
    return hashes.join(ingest_file.select("hash", "state", "reason"), "hash", "left")


@dataclass
class Outcome:
    """What a batch did, or would do: files by state, rows by outcome, questions asked, and what followed."""

    dry_run: bool
    files: dict[str, int] = field(default_factory=dict)
    rows: dict[tuple[str, str], int] = field(default_factory=dict)
    events: int = 0
    blocked: int = 0
    failed: int = 0
    #: event, state (blocked or failed) and fault of the events that didn't commit, a written table
    stopped: DataFrame | None = None
    reviews_opened: int = 0
    retained: int = 0
    removed: int = 0
    folder_removed: bool = False
    snapshot: str | None = None
    error: str | None = None


def work_orders(store: Store, orders: DataFrame, actor: str) -> DataFrame:
    """The project of each work order (home, report_no), found by name or made under its report's project: home, uuid_project.

    A report's project adopts no parent; a work order that is its own report stays a root.
    """
    project = store.read("project")
    reports = find_or_create(orders.where("report_no <> home").select(F.col("report_no").alias("name"), F.lit("Report").alias("type")), project, ["name", "type"], "pr-")
    homes = find_or_create(orders.select(F.col("home").alias("name"), F.lit("Work order").alias("type")), project, ["name", "type"], "pr-")
    up = orders.where("report_no <> home").join(reports.select(F.col("name").alias("report_no"), F.col("uuid").alias("uuid_parent")), "report_no")
    up = up.groupBy(F.col("home").alias("name")).agg(F.min("uuid_parent").alias("uuid_parent"))
    new = reports.where("is_new").select("uuid", "name", "type", F.lit(None).cast("string").alias("uuid_parent"))
    new = new.union(homes.where("is_new").join(up, "name", "left").select("uuid", "name", "type", "uuid_parent"))
    new = written(shaped(new.withColumn("uuid_root", F.col("uuid_parent")), "project"), "ingest-projects")
    found = written(homes.select(F.col("name").alias("home"), F.col("uuid").alias("uuid_project")), "ingest-homes")
    store.append("project", new, actor, "projects of a batch")
    return found


def _dangling(store: Store, clean: DataFrame, actor: str) -> DataFrame:
    """clean with an alias for each unknown point and a method for each unknown analyte, made where there is none."""
    alias, method = store.read("feature_alias"), store.read("lab_method")
    unknown = clean.where("feature_pending")
    seen = written(commit.materialise_aliases(unknown.select("alias_key", F.col("feature_raw").alias("name"), "date", "datetime"), alias), "ingest-aliases")
    names = first_by(unknown.select("alias_key", "row", F.col("feature_raw").alias("name")), ["alias_key"], [F.col("row")]).select("alias_key", "name")
    new = seen.where("is_new").join(names, "alias_key").select("uuid", "alias_key", "name", F.lit("pending").alias("kind"), F.lit(False).alias("auto_assign"), "date_start", "n_seen")
    new = written(shaped(new, "feature_alias"), "ingest-new-aliases")
    again = seen.where("not is_new").select("uuid", "n_seen")  # a stored bound isn't touched
    store.append("feature_alias", new, actor, "unknown points")
    if not again.isEmpty():
        store.update("feature_alias", written(again, "ingest-seen-again"), actor, "seen again")

    unknown = clean.where("analyte_pending and uuid_lab is null")
    keys = ["org", "name_key", "meth_key"]
    known = unknown.where("org is not null and name_key is not null")
    named = known.select(*keys, "row", F.col("analyte_raw").alias("name"), F.col("method_raw").alias("method"), F.col("units_raw").alias("units"), "rl_low")
    g = first_by(named, keys, [F.col("row")])  # all that is recorded is of one row
    g = written(g.withColumn("uuid", made("lm-", *keys)), "ingest-methods").join(method.select("uuid"), "uuid", "left_anti")
    store.append("lab_method", shaped(g.withColumn("organisation", F.col("org")), "lab_method"), actor, "unknown methods")

    drift = written(commit.units_sightings(clean.where("analyte_pending"), method), "ingest-drift")
    if not drift.isEmpty():
        store._log(drift, "lab_method", "provenance", actor, "units drift", None)

    out = clean.join(seen.select("alias_key", F.col("uuid").alias("_alias")), "alias_key", "left")
    out = out.withColumn("uuid_alias", F.coalesce("uuid_alias", F.when(F.col("feature_pending"), F.col("_alias")))).drop("_alias")
    needs = F.col("analyte_pending") & F.col("uuid_lab").isNull() & F.col("org").isNotNull() & F.col("name_key").isNotNull()
    out = out.withColumn("uuid_lab", F.coalesce("uuid_lab", F.when(needs, made("lm-", *keys))))
    return out


def visits(store: Store) -> DataFrame:
    """The stored samples as what identifies them: uuid, point (or alias without one), date, datetime."""
    alias = store.read("feature_alias").select(F.col("uuid").alias("uuid_feature_alias"), "uuid_feature")
    return store.read("sample").join(alias, "uuid_feature_alias").select("uuid", F.coalesce("uuid_feature", "uuid_feature_alias").alias("point"), "date", "datetime")


def _new_reviews(store: Store, asked: DataFrame) -> DataFrame:
    new = asked.withColumn("uuid", made("rq-", "event", "kind", "subkind", "key", "source_hash", "source_ref")).dropDuplicates(["uuid"])
    return new.join(store.read("review_queue").select("uuid"), "uuid", "left_anti")


def open_reviews(store: Store, asked: DataFrame, actor: str) -> int:
    """Add questions (event, kind, subkind, key, source_hash, source_ref, uuid_existing, candidates, payload) that aren't stored yet, and their candidates; how many."""
    new = written(_new_reviews(store, asked), "ingest-reviews")
    n = new.count()
    if n:
        home = F.nullif(F.regexp_replace("event", "^wo::", ""), F.col("event"))
        rows = new.select("*", F.lit("open").alias("status"), home.alias("work_order"))
        store.append("review_queue", shaped(rows, "review_queue"), actor, "questions of a batch")
        each = new.select(F.col("uuid").alias("uuid_review"), F.posexplode("candidates").alias("_p", "uuid_feature")).withColumn("rank", F.col("_p") + 1)
        store.append("review_queue_candidate", shaped(each.withColumn("uuid", made("rc-", "uuid_review", "rank")), "review_queue_candidate"), actor, "candidates")
    return n


@dataclass
class Committed:
    """What a commit did: events stopped by the guard and events refused (event, fault), and how many questions were opened."""

    blocked: DataFrame
    refused: DataFrame
    reviews_opened: int
    rows: list = field(default_factory=list)


def guard_questions(stopped: DataFrame, queue: DataFrame) -> DataFrame:
    """The questions of blocked events (event, work_order and counts) that aren't open yet."""
    asked = queue.where("kind = 'work_order_reingest' and status = 'open'").select("work_order").distinct()
    none = F.lit(None).cast("string")
    return stopped.join(asked, "work_order", "left_anti").select(
        "event", F.lit("work_order_reingest").alias("kind"), none.alias("subkind"), F.col("work_order").alias("key"), none.alias("source_hash"), none.alias("source_ref"), none.alias("uuid_existing"),
        F.array().cast("array<string>").alias("candidates"), F.to_json(F.struct("work_order", "n_samples", "n_prior_assets", "n_unmatched")).alias("payload"),
    )


def commit_events(store: Store, rows: DataFrame, files: DataFrame, actor: str, reason: str) -> Committed:
    """Commit reconciled rows and their files in one transaction.

    rows: as reconcile_events gives them, of events that share no point and day. files: hash,
    filename, content, adapter, revision, home, event, report_no. Events of a work order that was
    ingested before, without a higher revision or rows that all match, are blocked: nothing of
    theirs is written but their archive and questions. Events with a row that several samples
    fit alike are refused: nothing of theirs is written but that their files failed. New rows are
    inserted, superseding ones update in place, and transcriptions are deleted after the
    laboratory's row is in. Retries change nothing.
    """
    with store.transaction():
        known, stored_visits = event.Registry.load(store), visits(store)
        decisions = event.guard(rows, files, store.read("ingest_file"), store.read("sample"), store.read("project"), store.read("asset"), stored_visits)
        stopped = written(decisions.where("decision = 'blocked'"), "ingest-blocked")
        blocked = stopped.select("event").distinct()
        clean = rows.where("disposition = 'clean'").join(blocked, "event", "left_anti")
        placed = written(samples.assigned(clean.select("row", "point", "date", "datetime"), stored_visits).drop(*samples.PLACE), "ingest-samples")
        refused = clean.join(placed.where("verdict = 'refuse'").select("row"), "row", "left_semi").select("event").distinct()
        refused = written(refused.withColumn("fault", F.lit("several samples fit alike")), "ingest-refused")
        failed = files.join(refused, "event")
        rows, clean, files = (d.join(refused, "event", "left_anti") for d in (rows, clean, files))

        orders = files.where("home is not null").join(blocked, "event", "left_anti").groupBy("home").agg(F.min("report_no").alias("report_no"))
        projects = work_orders(store, orders, actor)
        clean = _dangling(store, clean, actor).join(projects, "home", "left").join(placed.select("row", "uuid_sample", "verdict", "made_at"), "row")
        clean = written(clean, "ingest-rows")
        new = clean.where("verdict = 'create'").groupBy(F.col("uuid_sample").alias("uuid")).agg(
            F.min("uuid_alias").alias("uuid_feature_alias"), F.min("date").alias("date"), F.min("made_at").alias("datetime"), F.min("uuid_project").alias("uuid_project")
        )
        store.append("sample", shaped(new, "sample"), actor, reason)
        commit_outcomes(store, clean.withColumn("outcome", F.col("reason")), actor, reason)
        gone = commit.deletions(clean.where("twin is not null").select(F.col("twin").alias("uuid_analysis")), store.read("analysis")).select("uuid")
        if not gone.isEmpty():
            store.delete("analysis", written(gone, "ingest-gone"), actor, "the laboratory's result is in")

        facts = commit.resolution_provenance(clean).withColumn("uuid", made("rs-", "uuid_sample", "uuid_alias", "resolution"))
        store.append("resolution", shaped(facts.join(store.read("resolution").select("uuid"), "uuid", "left_anti"), "resolution"), actor, reason)
        again = rows.where("reason = 'already_present'").select(F.col("e_uuid").alias("uuid_analysis"), "source_hash", "source_ref").withColumn("uuid", made("sa-", "uuid_analysis", "source_hash", "source_ref"))
        store.append("seen_again", shaped(again.join(store.read("seen_again").select("uuid"), "uuid", "left_anti"), "seen_again"), actor, reason)

        archive.archive_files(store, files.join(projects, "home", "left"))
        n = open_reviews(store, _asked(rows, stopped, store.read("review_queue")), actor)

        held = rows.groupBy("event").agg(F.count_if(F.col("disposition") == "clean").alias("_clean"), F.count_if(F.col("disposition") == "review").alias("_review"))
        state = files.join(held, "event", "left").join(blocked.withColumn("_stopped", F.lit(True)), "event", "left")
        waiting = values.is_true(F.col("_stopped")) | values.is_true((F.col("_review") > 0) & (F.col("_clean") == 0))
        state = state.withColumn("state", F.when(F.col("state") == "ignored", "ignored").when(waiting, "needs_review").otherwise("archived"))
        columns = ["hash", "filename", F.col("home").alias("work_order"), "revision", "adapter", "state", "reason"]
        lost = failed.withColumns({"state": F.lit("failed"), "reason": F.concat(F.lit("commit: "), "fault")}).select(*columns)
        set_states(store, state.select(*columns).unionByName(lost), actor)
        return Committed(written(blocked, "ingest-blocked"), refused, n)


def _asked(rows: DataFrame, stopped: DataFrame, queue: DataFrame) -> DataFrame:
    """The questions of rows and of the guard; a blocked event about which all is asked already asks nothing again."""
    new = guard_questions(stopped, queue)
    silent = stopped.select("event").distinct().join(new.select("event"), "event", "left_anti")
    return event.questions(rows.join(silent, "event", "left_anti")).drop("n_rows").unionByName(new)


def contained(events: DataFrame, run: Callable[[DataFrame], object], depth: int = 0) -> tuple[list, DataFrame | None]:
    """run(events) where it can be done: its results, and the events that fail (event, fault) or None.

    If it raises for several events, each half is tried, until those that fail stand alone; so a
    few bad events cost a few runs more each. What fails without any event is nobody's fault and is raised.
    """
    try:
        return [run(events)], None
    except Conflict:
        raise
    except Exception as e:  # noqa: BLE001 - whatever an event does wrong stays its own
        if depth == 0:
            run(events.limit(0))
        if events.limit(2).count() < 2:
            return [], events.withColumn("fault", F.lit(f"{type(e).__name__}: {e}"[:500]))
    done, failed = [], None
    for bit in (0, 1):
        half = written(events.where(F.shiftrightunsigned(F.xxhash64("event"), depth).bitwiseAND(F.lit(1)) == bit), "ingest-half")
        if not half.isEmpty():
            more, bad = contained(half, run, depth + 1)
            done += more
            failed = bad if failed is None else failed if bad is None else failed.union(bad)
    return done, failed


def retain_siblings(store: Store, files: DataFrame, routed: DataFrame, actor: str) -> int:
    """Archive deliverables that no adapter reads (certificates, custody, quality control, reports) with their work order; how many.

    files: all files of the batch's folders. routed: hash, state, reason of new ones. A file's
    work order is the one in its name, else the only one that names in its folder state; either way it
    must be a stored project. The others stay in quarantine.
    """
    known = store.read("project").groupBy(F.col("name").alias("work_order")).agg(F.min("uuid").alias("uuid_project"))
    unread = files.join(routed.where("state = 'quarantined' and reason = 'unclaimed'").select("hash"), "hash", "left_semi").where(adapters.is_deliverable(F.col("filename")))
    only = asm.unanimous(files.where("work_order_guess is not null"), "folder", "work_order_guess").withColumnRenamed("work_order_guess", "_of_folder")
    found = first_by(unread, ["hash"], [F.col("path")]).join(only, "folder", "left").withColumn("work_order", F.coalesce("work_order_guess", "_of_folder"))
    found = written(found.join(known, "work_order").withColumn("type", adapters.asset_type(F.col("filename"))), "ingest-siblings")
    n = found.count()
    if n:
        with store.transaction():
            archive.archive_files(store, found)
            kept = found.select("hash", "filename", "work_order", F.col("revision_guess").alias("revision"), F.lit("archived").alias("state"), F.lit("retained_sibling").alias("reason"))
            set_states(store, kept.withColumn("adapter", F.lit(None).cast("string")), actor)
    return n


def set_states(store: Store, files: DataFrame, actor: str) -> None:
    """Record files (hash, filename, work_order, revision, adapter, state, reason): known ones change, new ones are added."""
    rows = written(shaped(first_by(files, ["hash"], [F.col("filename")]).withColumn("uuid", F.concat(F.lit("file-"), "hash")), "ingest_file"), "ingest-states")
    old = store.read("ingest_file").select("uuid")
    change = rows.join(old, "uuid", "left_semi").select("uuid", "state", "reason", "adapter")
    store.append("ingest_file", rows.join(old, "uuid", "left_anti"), actor, "files of a batch")
    if not change.isEmpty():
        store.update("ingest_file", written(change, "ingest-changes"), actor, "files of a batch")


def ingest_dir(
    store: Store, path: str, registry: src.Registry | None = None, dry_run: bool = False, reconsider: bool = False, remove: bool = False,
    snapshot: str | None = None, actor: str = "ingest",
) -> Outcome:
    """Ingest the files directly in a folder as one batch.

    Files of a known content keep their state, but for those that failed or found no
    adapter, which `reconsider` routes again. dry_run reconciles and changes nothing.
    snapshot names a copy of the store made after the commit; remove deletes, after it, the
    files whose archived copy is sound.
    """
    return ingest_files(store, written(src.read_files(store.spark, path), "ingest-files"), path, registry, dry_run, reconsider, remove, snapshot, actor)


def sighted(store: Store, files: DataFrame, batch: str | None, actor: str) -> None:
    """Record where contents were seen, each (hash, path) once, and that a batch is done: in one transaction."""
    with store.transaction():
        seen = files.select("hash", "path").distinct().withColumn("uuid", made("is-", "hash", "path"))
        store.append("ingest_sighting", shaped(written(seen.join(store.read("ingest_sighting").select("uuid"), "uuid", "left_anti"), "ingest-sightings"), "ingest_sighting"), actor, "sightings")
        if batch is not None:
            store.append("ingest_batch", store.spark.range(1).select(F.lit(batch).alias("uuid"), F.lit(files.count()).alias("n_files")), actor, "batch done")


def ingest_files(
    store: Store, files: DataFrame, path: str, registry: src.Registry | None = None, dry_run: bool = False, reconsider: bool = False, remove: bool = False,
    snapshot: str | None = None, actor: str = "ingest", batch: str | None = None,
) -> Outcome:
    """ingest_dir for files (as read_files gives them, a written table) from anywhere. batch: a name that is recorded once all is done."""
    spark = store.spark
    if not dry_run:
        ensure_schema(store)
        sighted(store, files, None, actor)
    registry = registry or adapters.built_in()
    recorded = store.read("ingest_file") if store.exists("ingest_file") else spark.createDataFrame([], SCHEMA["ingest_file"])
    stale = src.is_reconsidered(F.col("state"), F.col("reason")) if reconsider else F.lit(False)
    settled = written(recorded.where(~stale).select("hash", "state", "reason"), "ingest-settled")
    fresh = written(adapters.described(files.join(settled, "hash", "left_anti")), "ingest-described")
    if fresh.isEmpty():  # nothing to decide; what an interrupted run left behind may still go
        out = Outcome(dry_run)
        if batch is not None and not dry_run:
            sighted(store, files, batch, actor)
        pending = remove and snapshot and not dry_run and not archive.removable(store, files).isEmpty()
        return _finished(store, files, settled.join(files.select("hash").distinct(), "hash", "left_semi"), out, path, snapshot if pending else None, remove)
    routed = written(src.route(fresh, src.claims(fresh, registry)), "ingest-routed")

    parsed = adapters.parse_claimed(fresh, routed, registry)
    parsed = adapters.Parsed(*[written(getattr(parsed, n), f"ingest-{n}") for n in ("results", "samples", "reports", "faults")])
    broken = parsed.faults.groupBy(F.col("source_hash").alias("hash")).agg(F.min("fault").alias("fault"))
    sound = first_by(fresh, ["hash"], [F.col("path")]).join(routed.where("state = 'claimed'").select("hash", "adapter"), "hash").join(broken, "hash", "left_anti")
    sound = sound.select("hash", "filename", "content", "adapter", "work_order_guess", "revision_guess")
    rows, asm_files = asm.assemble(parsed.results, parsed.samples, parsed.reports, sound)
    asm_files = written(asm_files, "ingest-assembled")
    rows = written(rows, "ingest-assembled-rows")
    events = written(asm_files.select("event").distinct(), "ingest-events")
    out = Outcome(dry_run, events=events.count())
    known = event.Registry.load(store) if store.exists("analysis") else _empty_registry(spark)
    parts, failed = contained(events, lambda some: written(event.reconcile_events(rows.join(some, "event", "left_semi"), known), "ingest-reconciled"))
    others = routed.where("state <> 'claimed'").select("hash", "filename", "adapter", "state", "reason")
    unread = others.union(routed.join(broken, "hash").select("hash", "filename", "adapter", F.lit("failed").alias("state"), F.concat(F.lit("parse:"), "fault").alias("reason")))
    if dry_run:
        return _foretold(store, out, parts, failed, asm_files, recorded, settled, unread, files, path)

    seen = unread.join(first_by(fresh, ["hash"], [F.col("path")]).select("hash", "work_order_guess", "revision_guess"), "hash")
    set_states(store, seen.withColumnsRenamed({"work_order_guess": "work_order", "revision_guess": "revision"}), actor)
    blocked = []
    if parts:
        done = functools.reduce(DataFrame.unionByName, parts)
        turns = written(_turns(done, asm_files, recorded), "ingest-turns")
        last = turns.agg(F.max("wave")).first()[0] or 0
        for turn in range(last + 1):
            mine = written(turns.where(F.col("wave") == turn).select("event"), "ingest-turn")

            def commit_some(some: DataFrame, turn: int = turn) -> Committed:
                picked = done.join(some, "event", "left_semi")
                if turn:  # what the turns before committed is stored by now
                    picked = written(event.reconcile_events(rows.join(some, "event", "left_semi"), event.Registry.load(store)), "ingest-reconciled")
                result = commit_events(store, picked, asm_files.join(some, "event", "left_semi"), actor, f"batch {path}")
                result.rows = event.outcome_counts(picked.join(result.refused, "event", "left_anti")).collect()
                return result

            results, bad = contained(mine, commit_some)
            for r in results:
                for c in r.rows:
                    out.rows[c.disposition, c.reason] = out.rows.get((c.disposition, c.reason), 0) + c.n
                out.reviews_opened += r.reviews_opened
                blocked.append(r.blocked.withColumn("state", F.lit("blocked")).withColumn("fault", F.lit(None).cast("string")))
                bad = r.refused if bad is None else bad.union(r.refused)
            failed = bad if failed is None else failed if bad is None else failed.union(bad)
    if failed is not None:
        failed = written(failed.distinct(), "ingest-failed")
        lost = asm_files.join(failed, "event").withColumns({"state": F.lit("failed"), "reason": F.concat(F.lit("commit: "), "fault")})
        set_states(store, lost.select("hash", "filename", F.col("home").alias("work_order"), "revision", "adapter", "state", "reason"), actor)
        blocked.append(failed.select("event", F.lit("failed").alias("state"), "fault"))
    _count_stopped(out, blocked)
    if out.events and out.failed == out.events:
        raise RuntimeError(f"every event of {path} failed: {out.stopped.first().fault}")
    out.retained = retain_siblings(store, files, others, actor)
    if batch is not None:
        sighted(store, files, batch, actor)
    return _finished(store, files, current_states(files.select("hash").distinct(), store.read("ingest_file")), out, path, snapshot, remove)


def _turns(done: DataFrame, files: DataFrame, recorded: DataFrame) -> DataFrame:
    """The turn of each event: those that share a point and day, or a work order, come one after the other."""
    place = F.concat_ws("|", F.lit("at"), "point", F.col("date").cast("string"))
    shared = done.where("point is not null and date is not null").select("event", place.alias("key"))
    shared = shared.union(event.work_orders(files, recorded).select("event", F.concat(F.lit("order|"), "work_order")))
    alone = files.select("event", F.lit(None).cast("string").alias("key"))
    return event.waves(shared.union(alone).join(done.select("event").distinct(), "event", "left_semi"), ["key"])


def _count_stopped(out: Outcome, parts: list[DataFrame]) -> None:
    if parts:
        out.stopped = written(functools.reduce(DataFrame.unionByName, parts), "ingest-stopped")
        n = {r.state: r["count"] for r in out.stopped.groupBy("state").count().collect()}
        out.blocked, out.failed = n.get("blocked", 0), n.get("failed", 0)


def _foretold(store: Store, out: Outcome, parts: list[DataFrame], failed: DataFrame | None, asm_files: DataFrame, recorded: DataFrame, settled: DataFrame, unread: DataFrame, files: DataFrame, path: str) -> Outcome:
    """What a batch would do, on reads alone: each event against what is stored now."""
    stopped = [] if failed is None else [failed.select("event", F.lit("failed").alias("state"), "fault")]
    if parts:
        done = functools.reduce(DataFrame.unionByName, parts)
        out.rows = {(r.disposition, r.reason): r.n for r in event.outcome_counts(done).collect()}
        if store.exists("sample"):
            there = visits(store)
            decisions = event.guard(done, asm_files, recorded, store.read("sample"), store.read("project"), store.read("asset"), there)
            held = written(decisions.where("decision = 'blocked'"), "ingest-blocked")
            none = F.lit(None).cast("string")
            stopped.append(held.select("event").distinct().select("event", F.lit("blocked").alias("state"), none.alias("fault")))
            clean = done.where("disposition = 'clean'").join(held, "event", "left_anti")
            torn = samples.existing(clean.select("row", "point", "date", "datetime"), there).where("verdict = 'refuse'")
            torn = clean.join(torn, "row", "left_semi").select("event").distinct()
            stopped.append(torn.select("event", F.lit("failed").alias("state"), F.lit("several samples fit alike").alias("fault")))
            out.reviews_opened = _new_reviews(store, _asked(done, held, store.read("review_queue"))).count()
    _count_stopped(out, stopped)
    new = asm_files.select("hash", "state").union(unread.select("hash", "state"))
    states = settled.select("hash", "state").join(files.select("hash").distinct(), "hash", "left_semi").union(new)
    return _finished(store, files, states, out, path, None, False)


def _finished(store: Store, files: DataFrame, states: DataFrame, out: Outcome, path: str, snapshot: str | None, remove: bool) -> Outcome:
    """A batch's end: the snapshot, then the removal that it allows, and files by their states."""
    if snapshot:
        store.snapshot(snapshot)
        out.snapshot = snapshot
        if remove:
            out.removed = archive.remove(store, files, path)
    out.files = {r.state: r["count"] for r in states.groupBy("state").count().collect()}
    return out


def _empty_registry(spark) -> event.Registry:
    none = lambda n: spark.createDataFrame([], SCHEMA[n])
    stored = "uuid string, point string, date date, datetime timestamp_ntz, uuid_lab string, uuid_analyte string, method string, organisation string, value double, value_chr string, quantified boolean, revision int, uuid_sample string"
    return event.Registry(none("feature"), none("feature_alias"), none("analyte"), none("lab_method"), none("analysis"), spark.createDataFrame([], stored))


def ingest_inbox(store: Store, root: str, **options) -> dict[str, Outcome]:
    """Ingest each folder directly in root as a batch of its own, in order of names.

    A folder that fails is reported in its outcome and the next goes on; its transaction
    leaves nothing behind. With `remove`, a folder in which nothing but ignored files is left goes too.
    """
    ignored = src.ignore_reason(F.col("ext"), F.col("filename"), F.col("size")).isNotNull()
    path = store.spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(store.spark._jsc.hadoopConfiguration())
    folders = sorted(f.getPath().toString() for f in fs.listStatus(path) if f.isDirectory())
    out: dict[str, Outcome] = {}
    for folder in folders:  # one batch each: a few folders a run, and every batch is distributed
        try:
            out[folder] = ingest_dir(store, folder, **options)
            if options.get("remove") and not options.get("dry_run"):
                out[folder].folder_removed = archive.remove_spent_folder(store, folder, root, ignored)
        except Exception as e:  # noqa: BLE001 - a batch's failure is its outcome
            out[folder] = Outcome(bool(options.get("dry_run")), error=f"{type(e).__name__}: {e}")
    return out
