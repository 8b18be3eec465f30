"""Review rows: payloads as JSON, ranked candidates and grouped questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payload keys that are arrays even with one value.
ARRAY_KEYS = ("candidates", "expired", "source_refs", "shadowed")


def payload(**fields: Column) -> Column:
    """A JSON object of the fields; nulls stay, ARRAY_KEYS are arrays."""
    parts = [(F.coalesce(c, F.array().cast("array<string>")) if k in ARRAY_KEYS else c).alias(k) for k, c in fields.items()]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}) if parts else F.lit("{}")


def review_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One question for each group of unresolved rows: source_refs in order, the union of candidates."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.array_join(F.array_sort(F.collect_set("source_ref")), ",").alias("source_ref"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("candidates", F.array().cast("array<string>")))))).alias("candidates"),
    )


def candidate_rows(reviews: DataFrame, key: str) -> DataFrame:
    """Child rows of reviews: each candidate with its rank from 1, then the expired ones."""
    both = F.concat(
        F.transform("candidates", lambda x: F.struct(x.alias("uuid_feature"), F.lit("candidate").alias("kind"))),
        F.transform("expired", lambda x: F.struct(x.alias("uuid_feature"), F.lit("expired").alias("kind"))),
    )
    return reviews.select(key, F.posexplode(both).alias("_p", "_x")).select(
        key, (F.col("_p") + 1).alias("rank"), F.col("_x.uuid_feature").alias("uuid_feature"), F.col("_x.kind").alias("kind")
    )


def payload_candidates(reviews: DataFrame, key: str) -> DataFrame:
    """Candidates that a payload holds, by rank from 1."""
    items = F.from_json(F.get_json_object("payload", "$.candidates"), "array<string>")
    return reviews.select(key, F.posexplode(items).alias("_p", "uuid_feature")).select(key, (F.col("_p") + 1).alias("rank"), "uuid_feature")


def already_open(new: DataFrame, open_reviews: DataFrame, path: str, on: str) -> DataFrame:
    """New reviews that no open one already asks (by a field of its payload)."""
    asked = open_reviews.where("status = 'open'").select(F.get_json_object("payload", path).alias("_k"))
    return new.join(asked, F.col(on) == F.col("_k"), "left_anti")


def spread_references(reviews: DataFrame, clean: DataFrame, key: str) -> DataFrame:
    """The alias that each review's rows took: the first reference (by place) that a clean row has."""
    refs = reviews.select(key, "source_hash", F.posexplode(F.split("source_ref", ",")).alias("_p", "ref"))
    exact = refs.join(clean.select(F.col("source_hash").alias("_h"), F.col("source_ref").alias("_r"), "uuid_alias"), (F.col("source_hash") == F.col("_h")) & (F.col("ref") == F.col("_r")))
    return exact.groupBy(key).agg(F.min(F.struct("_p", "uuid_alias"))["uuid_alias"].alias("uuid_alias"))
