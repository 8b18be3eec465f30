"""Assembly: files into events, best source, foreign rows and the coalescing sample join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, text, values

# Rank of sources by adapter; others rank 0.
SOURCE_RANK = {"esdat": 3, "als_enmrg": 2, "als_xtab": 1}
FIELD_WORKBOOK = "acirl_field_xlsx"


def source_rank(adapter: Column) -> Column:
    name = text.adapter_id(adapter)
    out = F.lit(0)
    for k, rank in SOURCE_RANK.items():
        out = F.when(name == k, rank).otherwise(out)
    return out


def event_id(home: Column, file_hash: Column) -> Column:
    """Files of one home work order are one event; a file without is an orphan of its own."""
    return F.coalesce(F.concat(F.lit("wo::"), home), F.concat(F.lit("__orphan__::"), file_hash))


def best_source(files: DataFrame) -> DataFrame:
    """Adds kept to files (event, adapter, revision, pos, n_results).

    Only files with results compete; the greatest rank wins, then revision (null last),
    then position. Field workbooks always stay.
    """
    exempt = text.adapter_id(F.col("adapter")) == FIELD_WORKBOOK
    competes = ~exempt & (F.col("n_results") > 0)
    order = Window.partitionBy("event", competes).orderBy(
        source_rank(F.col("adapter")).desc(), F.col("revision").desc_nulls_last(), "pos"
    )
    return files.withColumn("kept", F.when(exempt, True).when(competes, F.row_number().over(order) == 1).otherwise(False))


def flag_foreign(rows: DataFrame) -> DataFrame:
    """Adds disposition to rows (work_order, home, sample_type): own, dropped_ncp or needs_review."""
    own = F.col("work_order").isNull() | F.col("home").isNull() | (F.col("work_order") == F.col("home"))
    return rows.withColumn(
        "disposition", F.when(own, "own").when(values.is_true(F.col("sample_type") == "NCP"), "dropped_ncp").otherwise("needs_review")
    )


def join_samples(results: DataFrame, samples: DataFrame, fill: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """Coalescing left join of samples onto results (row, lab_sample_id, feature_raw, sample_type, fill...).

    A result with an id matches by id alone; one without by its squished feature text.
    Columns in fill take the first value (by pos) where they are null, sample_type takes
    the first in any case. Adds datetime_mismatch and type_mismatch where the matches
    name several days or types. `within` are columns that both must have alike (an event).
    """
    scope = [F.col(c).alias(f"_in_{c}") for c in within]
    same = F.lit(True)
    for c in within:
        same = same & (F.col(c) == F.col(f"_in_{c}"))
    agg = [F.min(F.when(F.col(c).isNotNull(), F.struct("pos", c))).alias(f"_{c}") for c in [*fill, "sample_type"]]
    agg += [F.count_distinct(F.to_date("sample_datetime")).alias("_days"), F.count_distinct("sample_type").alias("_types")]
    by_id = samples.where("lab_sample_id is not null").groupBy(*scope, F.col("lab_sample_id").alias("_id")).agg(*agg)
    named = samples.where("feature_raw is not null").groupBy(*scope, text.squish_key(F.col("feature_raw")).alias("_name")).agg(*agg)

    def attach(rows: DataFrame, side: DataFrame, on: Column) -> DataFrame:
        out = rows.join(side, on, "left")
        for c in fill:
            out = out.withColumn(c, F.coalesce(c, F.col(f"_{c}.{c}")))
        return (
            out.withColumn("sample_type", F.coalesce(F.col("_sample_type.sample_type"), "sample_type"))
            .withColumn("datetime_mismatch", values.is_true(F.col("_days") > 1))
            .withColumn("type_mismatch", values.is_true(F.col("_types") > 1))
            .select(*results.columns, "datetime_mismatch", "type_mismatch")
        )

    with_id = attach(results.where("lab_sample_id is not null"), by_id, same & (F.col("lab_sample_id") == F.col("_id")))
    without = attach(results.where("lab_sample_id is null"), named, same & (text.squish_key(F.col("feature_raw")) == F.col("_name")))
    return with_id.unionByName(without)


def unanimous(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The value of groups whose rows all name the same one (nulls ignored)."""
    g = rows.groupBy(group).agg(F.collect_set(value).alias("_v"))
    return g.where("size(_v) = 1").select(group, F.col("_v")[0].alias(value))


def home_work_order(report: Column, guess: Column) -> Column:
    """A file's home: the work order that its header states, else the one its name suggests."""
    return F.coalesce(F.nullif(F.trim(report), F.lit("")), guess)


def flag_conflict(rows: DataFrame, when: Column, subkind: str, extra: Column) -> DataFrame:
    """Rows (needs_review, review_kind, review_subkind, review_facts) that a condition flags too.

    The first flag names the kind; the facts (a map) of every flag are kept.
    """
    hit = values.is_true(when)
    facts = F.coalesce("review_facts", F.create_map().cast("map<string,string>"))
    return (
        rows.withColumn("review_facts", F.when(hit, F.map_concat(F.map_filter(facts, lambda k, v: ~F.array_contains(F.map_keys(extra), k)), extra)).otherwise(F.col("review_facts")))
        .withColumn("review_subkind", F.when(hit & F.col("review_kind").isNull(), F.lit(subkind)).otherwise(F.col("review_subkind")))
        .withColumn("review_kind", F.when(hit, F.coalesce("review_kind", F.lit("value_conflict"))).otherwise(F.col("review_kind")))
        .withColumn("needs_review", F.col("needs_review") | hit)
    )


def assemble(results: DataFrame, samples: DataFrame, reports: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of events, and the files with their event and state.

    files: hash, filename, adapter, work_order_guess, revision_guess. Files of one home
    work order are one event. Of competing laboratory renderings the best stays; rows of
    other work orders are flagged for review, or dropped if they are other clients'
    parents. Samples of all an event's files complete its results. Files that lose are
    `ignored` as superseded_by_better_source; the others are `assembled`.
    """
    said = reports.groupBy(F.col("source_hash").alias("hash")).agg(F.min("work_order").alias("_said"), F.min("report_no").alias("report_no"))
    n = results.groupBy(F.col("source_hash").alias("hash")).agg(F.count("*").alias("n_results"))
    f = files.join(said, "hash", "left").join(n, "hash", "left").fillna({"n_results": 0})
    f = f.withColumn("home", home_work_order(F.col("_said"), F.col("work_order_guess"))).drop("_said")
    f = f.withColumn("event", event_id(F.col("home"), F.col("hash"))).withColumn("orphan", F.col("home").isNull())
    f = best_source(f.withColumn("revision", F.col("revision_guess")).withColumn("pos", F.col("hash")))
    lost = ~F.col("kept") & (F.col("n_results") > 0)
    f = f.withColumn("state", F.when(lost, "ignored").otherwise("assembled")).withColumn("reason", F.when(lost, "superseded_by_better_source"))

    mine = f.where(~lost).select(F.col("hash").alias("source_hash"), "event", "orphan", "home", F.col("revision_guess").alias("revision"))
    rows = flag_foreign(results.join(mine, "source_hash")).where("disposition <> 'dropped_ncp'")
    foreign = F.col("disposition") == "needs_review"
    rows = rows.select(
        F.concat_ws("/", "source_hash", "source_ref").alias("row"), *[c for c in rows.columns if c != "disposition"], foreign.alias("needs_review"),
        F.when(foreign, "other").alias("review_kind"), F.when(foreign, "foreign_work_order").alias("review_subkind"),
        F.when(foreign, F.create_map(F.lit("foreign_work_order"), F.col("work_order"))).alias("review_facts"),
    )
    of = f.select(F.col("hash").alias("source_hash"), "event")
    fill = ["feature_raw", "sample_datetime_raw", "parent_sample", "matrix_raw"]
    local = F.coalesce(*[dates.parse_local(F.col("sample_datetime_raw"), k) for k in ("esdat", "crosstab", "iso")])
    s = samples.join(of, "source_hash").withColumn("sample_datetime", local).withColumn("pos", F.concat_ws("/", "source_hash", "source_ref"))
    for c in ("parent_sample", "matrix_raw"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    rows = join_samples(rows, s, fill, ("event",))
    for mark in ("datetime_mismatch", "type_mismatch"):
        rows = flag_conflict(rows, F.col(mark), mark, F.create_map(F.lit(mark), F.coalesce("lab_sample_id", "feature_raw"))).drop(mark)
    return rows, f
