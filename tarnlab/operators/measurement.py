"""Measurement views: the spine join, the canonical-row rank, mask variants and activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, values
from ..warehouse.scratch import written
from .joins import prefixed

NEUTRAL_PREFERENCE = 500


def spine(analysis: DataFrame, sample: DataFrame, alias: DataFrame, feature: DataFrame, method: DataFrame, how: str = "inner") -> DataFrame:
    """analysis - sample - alias - feature, and - method: columns prefixed a_, s_, fa_, f_, m_.

    Samples get their features first, analyses their methods: only the last join moves analyses a second time.
    """
    at = prefixed(sample, "s_").join(prefixed(alias, "fa_"), F.col("s_uuid_feature_alias") == F.col("fa_uuid"))
    at = at.join(prefixed(feature, "f_"), F.col("fa_uuid_feature") == F.col("f_uuid"))
    by = prefixed(analysis, "a_").join(prefixed(method, "m_"), F.col("a_uuid_lab") == F.col("m_uuid"), how)
    out = by.join(at, F.col("a_uuid_sample") == F.col("s_uuid"))
    sides = (("a_", analysis), ("s_", sample), ("fa_", alias), ("f_", feature), ("m_", method))
    return out.select(*[f"{p}{c}" for p, df in sides for c in df.columns])


def with_preference_rank(rows: DataFrame) -> DataFrame:
    """Adds date, is_field and preference_rank to spine rows; none is dropped.

    Rows compete within one feature, civil day and analyte: explicit preference first,
    then field over laboratory, then ALS; a row without an analyte competes with nobody.
    """
    rows = rows.withColumn("date", dates.civil_date(F.col("s_datetime"))).withColumn("is_field", values.is_field(F.col("m_method")))
    rival = F.coalesce("m_uuid_analyte", F.concat(F.lit("analysis:"), "a_uuid"))
    order = Window.partitionBy("f_uuid", "date", rival).orderBy(
        F.coalesce("m_preference", F.lit(NEUTRAL_PREFERENCE)),
        F.desc("is_field"),
        F.coalesce(F.col("m_organisation") == "ALS", F.lit(False)).desc(),
        "s_uuid",
        "a_uuid",
    )
    return rows.withColumn("preference_rank", F.row_number().over(order))


def rank_by_runs(rows: DataFrame) -> DataFrame:
    """preference_rank by another way, to hold against with_preference_rank: no window, but one sort of all rows.

    All rows are sorted by ranges of key and preference; a row's place in that order, less the place
    at which its key's run begins, is its rank, wherever partitions part the run.
    """
    day = dates.civil_date(F.col("s_datetime"))
    rival = F.when(F.col("m_uuid_analyte").isNull(), F.concat(F.lit("analysis:"), "a_uuid")).otherwise(F.col("m_uuid_analyte"))
    better = F.when(F.col("m_preference").isNull(), NEUTRAL_PREFERENCE).otherwise(F.col("m_preference"))
    not_field = F.when(values.is_field(F.col("m_method")), 0).otherwise(1)
    not_als = F.when(F.col("m_organisation") == "ALS", 0).otherwise(1)
    keyed = rows.select("a_uuid", F.struct("f_uuid", day.alias("date"), rival.alias("rival")).alias("key"), F.struct(better.alias("better"), not_field.alias("lab"), not_als.alias("other"), "s_uuid", "a_uuid").alias("place"))
    placed = written(keyed.repartitionByRange("key", "place").sortWithinPartitions("key", "place").select("a_uuid", "key", F.monotonically_increasing_id().alias("at")), "rank-runs")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each partition
    before = sizes.alias("a").join(F.broadcast(sizes.alias("b")), F.col("b.part") < F.col("a.part"), "left").groupBy("a.part").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    all_ = placed.withColumn("part", part).join(F.broadcast(before), "part").select("a_uuid", "key", (F.col("before") + within).alias("ordinal"))
    runs = all_.groupBy("key").agg(F.min("ordinal").alias("begin"))
    return all_.join(runs, "key").select("a_uuid", (F.col("ordinal") - F.col("begin") + 1).cast("int").alias("preference_rank"))


def measurement(analysis: DataFrame, sample: DataFrame, alias: DataFrame, feature: DataFrame, method: DataFrame, analyte: DataFrame) -> DataFrame:
    """The measurement view: spine rows with an analyte, ranked."""
    rows = with_preference_rank(spine(analysis, sample, alias, feature, method))
    return rows.join(prefixed(analyte, "an_"), F.col("m_uuid_analyte") == F.col("an_uuid"))


def measurement_variant(
    analysis: DataFrame, sample: DataFrame, alias: DataFrame, feature: DataFrame, method: DataFrame, mask: DataFrame, variant: str
) -> DataFrame:
    """The view under a mask: only features the mask names (variant in any case); rows without a method stay."""
    named = mask.where(F.upper("variant") == variant).groupBy(F.col("uuid_feature").alias("uuid")).agg(F.collect_list(F.struct("uuid_feature", "name")).alias("_named"))
    # ranks are taken within a feature, so its names may come before them
    rows = with_preference_rank(spine(analysis, sample, alias, feature.join(named, "uuid"), method, "left"))
    rest = [c for c in rows.columns if c != "f__named"]
    return rows.select(*rest, F.explode("f__named").alias("_n")).select(*rest, F.col("_n.uuid_feature").alias("k_uuid"), F.col("_n.name").alias("k_name"))


def feature_dates(sample: DataFrame, alias: DataFrame) -> DataFrame:
    """First and last civil day with a sample of each feature."""
    rows = sample.join(alias.select(F.col("uuid").alias("fa"), "uuid_feature"), F.col("uuid_feature_alias") == F.col("fa"))
    day = dates.civil_date(F.col("datetime"))
    return rows.where("uuid_feature is not null").groupBy("uuid_feature").agg(F.min(day).alias("date_start"), F.max(day).alias("date_end"))


def alias_usage(alias: DataFrame, sample: DataFrame, feature: DataFrame) -> DataFrame:
    """How often each alias is used, and whether its key is also the folded name of another feature."""
    used = sample.groupBy(F.col("uuid_feature_alias").alias("fa")).agg(F.count("*").alias("n"))
    clash = feature.select(F.lower("name").alias("key"), F.col("uuid").alias("other"))
    out = alias.join(used, alias.uuid == used.fa, "left").join(
        clash, (F.col("alias_key") == F.col("key")) & ~F.col("other").eqNullSafe(F.col("uuid_feature")), "left"
    )
    return out.groupBy("uuid", "kind").agg(
        F.max(F.coalesce("n", F.lit(0))).alias("n_samples"), F.count("other").alias("n_clashes")
    )


def activity_window(feature: DataFrame, alias: DataFrame, sample: DataFrame) -> DataFrame:
    """Samples under each feature's own alias: count, first and last day; features without any stay."""
    own = alias.where("kind = 'self'").select(F.col("uuid").alias("fa"), "uuid_feature")
    out = feature.select("uuid", "name").join(own, F.col("uuid") == F.col("uuid_feature"), "left")
    s = sample.select(F.col("uuid").alias("s"), F.col("uuid_feature_alias").alias("sfa"), dates.civil_date(F.col("datetime")).alias("day"))
    return out.join(s, F.col("fa") == F.col("sfa"), "left").groupBy("uuid").agg(
        F.count("s").alias("n_samples"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )
