"""Join strategy for registries.

A registry side is broadcast only if its size is known to be small: Catalyst does so
by itself below `spark.sql.autoBroadcastJoinThreshold`, from the scan's statistics, and
shuffles beyond it. So no operator here hints `broadcast` on a registry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in a total order; other rows go."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
