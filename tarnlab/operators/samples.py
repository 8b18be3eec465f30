"""Identity of samples: which stored sample a row belongs to, or whether it needs one of its own.

A row has a point (or an alias without one), a day and perhaps an instant. Of the samples at
that point and day it takes the one at its instant; without such a one it takes the only one
there is, unless all are dated otherwise: then it needs a new one. Where several remain the
row is refused, as nothing tells them apart.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE = ("point", "date")
KEY = (*PLACE, "datetime")


def _same(left: str, right: str, keys: tuple[str, ...]) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _facts(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """keys with what is stored there: n samples at the place, how many undated, the least id; m at the instant, and their least id."""
    at = stored.groupBy(*KEY).agg(F.count("*").alias("m"), F.min("uuid").alias("at_uuid"))
    place = stored.groupBy(*PLACE).agg(F.count("*").alias("n"), F.count_if(F.col("datetime").isNull()).alias("undated"), F.min("uuid").alias("only"))
    out = keys.alias("k").join(at.alias("a"), _same("k", "a", KEY), "left").select("k.*", "m", "at_uuid")
    out = out.alias("k").join(place.alias("p"), _same("k", "p", PLACE), "left").select("k.*", "n", "undated", "only")
    return out.fillna({"m": 0, "n": 0, "undated": 0})


def existing(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The stored sample of each row: row, verdict (reuse, create, refuse) and uuid_sample, null unless it is reused.

    rows: row, point, date, datetime. stored: uuid and the same. Rows don't see each other. A
    null point or day matches no sample.
    """
    known = F.col("datetime").isNotNull()
    keys = rows.where("point is not null and date is not null").select(*KEY).distinct()
    f = _facts(keys, stored)
    left = F.when(known & (F.col("m") > 0), F.col("m")).otherwise(F.col("n"))  # how many candidates remain
    verdict = (
        F.when(F.col("n") == 0, "create").when(known & (F.col("m") == 0) & (F.col("undated") == 0), "create").when(left > 1, "refuse").otherwise("reuse")
    )
    f = f.select(*KEY, verdict.alias("verdict"), F.when(known & (F.col("m") > 0), F.col("at_uuid")).otherwise(F.col("only")).alias("u"))
    out = rows.alias("r").join(f.alias("k"), _same("r", "k", KEY), "left")
    reuse = F.when(F.col("verdict") == "reuse", F.col("u"))
    return out.select("r.row", F.coalesce("verdict", F.lit("create")).alias("verdict"), reuse.alias("uuid_sample"))


def assigned(rows: DataFrame, stored: DataFrame, prefix: str = "s-") -> DataFrame:
    """Samples of a batch's rows, each of which sees those that earlier ones made: row, point, date, verdict, uuid_sample, made_at.

    rows: row (also their order), point, date, datetime; a null point or day is refused. What taking them one by one gives has a
    closed form. At a place without samples an undated first row makes the only one there will
    be; else each instant makes its own. Where all stored ones are dated each new instant
    makes one; where one is undated none is ever made. So an undated row's candidates
    are the stored ones and the instants made before it, of which only the first two matter.
    """
    known = F.col("datetime").isNotNull()
    rows = rows.select("row", *KEY)
    placed = rows.where("point is not null and date is not null")
    first = placed.groupBy(*KEY).agg(F.min("row").alias("o"))
    f = _facts(first, stored)
    # a place's instants, each once
    place = Window.partitionBy(*PLACE)
    f = f.withColumn("lead_at", F.min_by("datetime", "o").over(place))
    from_undated = (F.col("n") == 0) & F.col("lead_at").isNull()
    makes = known & ~from_undated & (F.col("undated") == 0) & (F.col("m") == 0)
    f = f.withColumn("_made", F.when(makes, F.col("o"))).withColumn("o1", F.min("_made").over(place))
    f = f.withColumn("o2", F.min(F.when(F.col("_made") > F.col("o1"), F.col("_made"))).over(place)).drop("_made")

    after = lambda o: F.coalesce(F.col("o") > F.col(o), F.lit(False)).cast("int")
    there = F.col("n") + F.when(F.col("undated") == 0, after("o1") + after("o2")).otherwise(0)  # two made are as many as more
    verdict = (
        F.when(from_undated | (known & (F.col("n") == 0)), "create")
        .when(known & (F.col("m") == 0) & (F.col("undated") == 0), "create")
        .when(known & (F.col("m") > 0), F.when(F.col("m") > 1, "refuse").otherwise("reuse"))
        .when(F.when(known, F.col("n")).otherwise(there) > 1, "refuse")
        .when(F.col("n") == 0, "create")
        .otherwise("reuse")
    )
    made_at = F.when(~from_undated, F.coalesce("datetime", "lead_at"))
    f = f.withColumn("verdict", verdict).withColumn("made_at", F.when(F.col("verdict") == "create", made_at))
    new_id = F.concat(F.lit(prefix), F.substring(F.sha2(F.to_json(F.struct(*PLACE, F.col("made_at").alias("datetime")), {"ignoreNullFields": "false"}), 256), 1, 32))
    old = F.when(known & (F.col("m") > 0), F.col("at_uuid")).otherwise(F.col("only"))
    f = f.select(*KEY, "verdict", "made_at", F.when(F.col("verdict") == "create", new_id).when(F.col("verdict") == "reuse", old).alias("uuid_sample"))
    out = rows.alias("r").join(f.alias("k"), _same("r", "k", KEY), "left")
    return out.select("r.row", *[f"r.{c}" for c in PLACE], F.coalesce("verdict", F.lit("refuse")).alias("verdict"), "uuid_sample", "made_at")
