"""Registry upkeep: collisions, duplicates of identity, merges, pending entries and checks."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values


def collisions(sample: DataFrame, alias: DataFrame, day: Column) -> DataFrame:
    """Samples of one feature on one day under several aliases: uuid_feature, day, uuid, fa, n_links.

    All samples of a (uuid_feature, day) with another alias collide with each other: the rows
    of a group say so once, with how many others each has, instead of every pair.
    """
    s = sample.join(alias.select(F.col("uuid").alias("fa"), "uuid_feature"), F.col("uuid_feature_alias") == F.col("fa"))
    s = s.where("uuid_feature is not null").select("uuid", "uuid_feature", "fa", day.alias("day")).where("day is not null")
    by_alias = s.groupBy("uuid_feature", "day", "fa").agg(F.count("*").alias("n"))
    groups = by_alias.groupBy("uuid_feature", "day").agg(F.sum("n").alias("total"), F.count("*").alias("aliases")).where("aliases > 1").drop("aliases")
    links = by_alias.join(groups, ["uuid_feature", "day"]).select("uuid_feature", "day", "fa", (F.col("total") - F.col("n")).alias("n_links"))
    return s.join(links, ["uuid_feature", "day", "fa"]).select("uuid_feature", "day", "uuid", "fa", "n_links")


def self_collisions(sample: DataFrame, day: Column) -> DataFrame:
    """Samples of one alias on one day, where there are several: uuid_feature_alias, day, uuid, n_links (the others)."""
    s = sample.select("uuid", "uuid_feature_alias", day.alias("day")).where("day is not null")
    groups = s.groupBy("uuid_feature_alias", "day").agg((F.count("*") - 1).alias("n_links")).where("n_links > 0")
    return s.join(groups, ["uuid_feature_alias", "day"]).select("uuid_feature_alias", "day", "uuid", "n_links")


def identity_duplicates(alias: DataFrame, feature: DataFrame) -> DataFrame:
    """Other aliases of a feature with the key of its own name, beside its own alias."""
    named = alias.join(feature.select(F.col("uuid").alias("f"), F.lower("name").alias("fold")), F.col("uuid_feature") == F.col("f")).where("alias_key = fold")
    own = named.where("kind = 'self'").select(F.col("f").alias("of"), F.col("uuid").alias("uuid_self"))
    rest = named.where("kind <> 'self'").select(F.col("f").alias("of"), F.col("uuid").alias("uuid_other"))
    return own.join(rest, "of")


def ambiguous_keys(alias: DataFrame) -> DataFrame:
    """Keys that reach more than one feature."""
    g = alias.where("uuid_feature is not null").groupBy("alias_key").agg(F.countDistinct("uuid_feature").alias("n_features"), F.count("*").alias("n_aliases"))
    return g.where("n_features > 1")


def without_self(feature: DataFrame, alias: DataFrame) -> DataFrame:
    own = alias.where("kind = 'self'").select(F.col("uuid_feature").alias("uuid"))
    return feature.join(own, "uuid", "left_anti")


def pending_features(alias: DataFrame, sample: DataFrame) -> DataFrame:
    """Dangling aliases and how many samples wait on each (zeros stay)."""
    used = sample.groupBy(F.col("uuid_feature_alias").alias("fa")).agg(F.count("*").alias("n"))
    return alias.where("uuid_feature is null").join(used, F.col("uuid") == F.col("fa"), "left").select(
        "uuid", "alias_key", F.coalesce("n", F.lit(0)).alias("n_samples")
    )


def pending_methods(method: DataFrame, analysis: DataFrame) -> DataFrame:
    used = analysis.groupBy(F.col("uuid_lab").alias("lab")).agg(F.count("*").alias("n"))
    return method.where("uuid_analyte is null").join(used, F.col("uuid") == F.col("lab"), "left").select(
        "uuid", "name", "organisation", F.coalesce("n", F.lit(0)).alias("n_analyses")
    )


def not_contained(loser: DataFrame, winner: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of loser without an equal (null-safe) row in winner: empty if winner holds all of loser."""
    w = winner.select(*[F.col(c).alias(f"_{c}") for c in keys]).distinct()
    on = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    return loser.join(w, on, "left_anti")


def merge_actions(loser: DataFrame, winner: DataFrame, keys: list[str]) -> DataFrame:
    """What becomes of each analysis of a sample that is merged into another: drop_equal, review or repoint."""
    w = winner.select(*keys, F.col("uuid").alias("w_uuid"), *[F.col(c).alias(f"w_{c}") for c in ("value", "value_chr", "quantified")])
    out = loser.join(w, keys, "left")
    same = values.values_equal(F.col("value"), F.col("value_chr"), F.col("quantified"), F.col("w_value"), F.col("w_value_chr"), F.col("w_quantified"))
    action = F.when(F.col("w_uuid").isNull(), "repoint").when(same, "drop_equal").otherwise("review")
    return out.withColumn("action", action)


def violations(rows: DataFrame, keys: list[str], uuid: str = "uuid") -> DataFrame:
    """Groups that break a unique key; rows with a null key part don't count. Most rows first."""
    g = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n"), F.min(uuid).alias("exemplar"))
    return g.where("n > 1").orderBy(F.desc("n"), "exemplar")


def units_drift(old: DataFrame, new: DataFrame, key: str, unit: str) -> DataFrame:
    """Every unit ever recorded for a key, old or new, once; keys with several drift."""
    return old.select(key, unit).union(new.select(key, unit)).where(F.col(unit).isNotNull()).distinct()


def fingerprint(columns: list[str]) -> list[Column]:
    """Aggregates that tell tables apart in any order: n, and the sum (total) and exclusive or (mix) of 32 bits of each row's MD5, nulls as `?`."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in columns])
    h = F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")
    return [F.count("*").alias("n"), F.sum(h).alias("total"), F.bit_xor(h).alias("mix")]


def checksum(rows: DataFrame) -> DataFrame:
    """Count and order-free fingerprint of a table."""
    return rows.agg(*fingerprint(rows.columns))


def full_diff(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys that one side lacks, or whose columns differ (null-safe)."""
    a = left.select(F.col(key).alias("k"), *[F.col(c).alias(f"l_{c}") for c in columns], F.lit(True).alias("in_left"))
    b = right.select(F.col(key).alias("k"), *[F.col(c).alias(f"r_{c}") for c in columns], F.lit(True).alias("in_right"))
    out = a.join(b, "k", "full")
    differ = functools.reduce(lambda x, y: x | y, [~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in columns], F.lit(False))
    kind = F.when(F.col("in_right").isNull(), "only_left").when(F.col("in_left").isNull(), "only_right").when(differ, "differs")
    return out.withColumn("kind", kind).where("kind is not null").select("k", "kind")


def retained(snapshots: DataFrame, today: Column, keep_days: int = 60) -> DataFrame:
    """Adds keep to snapshots (day): young ones, and the last one of each month."""
    from pyspark.sql import Window

    last = F.max("day").over(Window.partitionBy(F.date_format("day", "yyyy-MM")))
    return snapshots.withColumn("keep", (F.datediff(today, "day") <= keep_days) | (F.col("day") == last))


def alias_rows(names: DataFrame, token_lists: DataFrame) -> DataFrame:
    """Alias registry from names and comma lists (uuid_feature, cypher): key, feature, times seen, and whether it assigns by itself."""
    from pyspark.sql import Window

    from ..functions import text

    exploded = token_lists.select("uuid_feature", F.explode(text.tokens(F.col("cypher"))).alias("name"))
    rows = names.select("uuid_feature", "name").unionByName(exploded).withColumn("alias_key", text.feature_key(F.col("name"))).where("alias_key is not null")
    g = rows.groupBy("alias_key", "uuid_feature").agg(F.count("*").alias("n_seen"))
    return g.withColumn("auto_assign", F.count("*").over(Window.partitionBy("alias_key")) == 1)
