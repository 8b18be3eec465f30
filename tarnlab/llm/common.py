"""What the operators of this subpackage share: tables in the shared folder,
Arrow batch sizes and connected components."""

from __future__ import annotations

import itertools
import json
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one Arrow batch sent to Python: whole texts may be long, so few at a time.
BATCH_ROWS = 512
#: And their bytes: a batch of very long texts stays small.
BATCH_BYTES = 16 << 20
#: At most so many keys are joined by broadcast for having many rows; keys with few never are.
HOT_KEYS = 1 << 14
HOT_ROWS = 10_000
#: Bits of the field that rows are filtered by before a join.
FILTER_BITS = 1 << 22


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only where the session names none (tests on one machine) a temporary
    folder is made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tarnlab-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_ROOTS: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for a table that only this application needs: its folder goes when the application ends."""
    root = f"{shared_dir(spark)}/tarnlab/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _ROOTS.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs no more than reading files again.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a bounded number of rows as a literal of the plan. schema: `name:type, ...` as in a struct."""
    names = [part.split(":")[0].strip() for part in re.split(r",(?![^<]*>)", schema)]
    data = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(data), f"array<struct<{schema}>>")))


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(columns: tuple[str, ...]) -> list[Column]:
    """Columns to carry through an operator as one, `_carry`, so their names clash with none inside."""
    return [F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_carry")] if columns else []


def uncarried(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The carried columns by their own names, behind the others."""
    if not columns:
        return df
    return df.select(*[c for c in df.columns if c != "_carry"], "_carry.*")


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each batch with its column `text` as Python strings."""
    for batch in batches:
        yield batch, batch.column(batch.schema.get_field_index("text")).to_pylist()


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of rows that follow each other with the same (integer) keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy() for c in keys])
        cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            now = tuple(k[:, a].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def hot_join(rows: DataFrame, dim: DataFrame, key: str, drop: str = "") -> DataFrame:
    """rows joined with the one row of each key of dim, whose column `rows` says how many rows have it.

    Keys of more than 1 / HOT_KEYS of all these rows are at most HOT_KEYS, so they are
    broadcast, however many rows they have; only the others are shuffled. dim should be
    a written table, as it is read more than once. `drop` names a column of dim to leave out.
    """
    total = dim.agg(F.sum("rows")).first()[0] or 0
    floor = max(total // HOT_KEYS, HOT_ROWS)
    hot = dim.where(F.col("rows") > floor)
    least = lambda d: d.drop(drop) if drop else d
    if hot.isEmpty():
        return rows.join(least(dim), key)
    marked = rows.join(F.broadcast(hot.select(key, F.lit(True).alias("_hot"))), key, "left")
    cold = marked.where("_hot is null").drop("_hot").join(least(dim.where(F.col("rows") <= floor)), key)
    warm = marked.where("_hot").drop("_hot").join(F.broadcast(least(hot)), key)
    return cold.unionByName(warm)


def hot_join_once(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """hot_join for rows that are dear to make: they are made once.

    Rows of hot keys, joined by broadcast, go through the others' shuffle dealt by their own hash.
    """
    total = dim.agg(F.sum("rows")).first()[0] or 0
    floor = max(total // HOT_KEYS, HOT_ROWS)
    hot = dim.where(F.col("rows") > floor)
    others = [c for c in dim.columns if c not in (key, "rows")]
    if hot.isEmpty():
        return rows.join(dim.drop("rows"), key)
    warm = F.broadcast(hot.select(key, F.struct(*others).alias("_hot")))
    cold = dim.where(F.col("rows") <= floor).select(F.col(key).alias("_k"), F.struct(*others).alias("_cold"))
    out = rows.join(warm, key, "left").withColumn("_k", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(F.xxhash64(*rows.columns)))
    out = out.join(cold, "_k", "left").withColumn("_found", F.coalesce("_hot", "_cold")).where("_found is not null")
    return out.select(*rows.columns, "_found.*")


def salted_join(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """rows joined with the one row of each key of dim, which may be large: keys of many rows are parted by salts.

    rows are read twice: once to count keys. A key's row of dim is copied once for every HOT_ROWS rows.
    """
    n = materialize(rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS), "hot-keys")
    if n.isEmpty():
        return rows.join(dim, key)
    salts = n.select(key, F.ceil(F.col("_n") / HOT_ROWS).cast("int").alias("_salts"))  # at most a key for every HOT_ROWS rows
    many = F.coalesce("_salts", F.lit(1))
    left = rows.join(salts, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), many).cast("int")).drop("_salts")
    right = dim.join(salts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), many - 1))).drop("_salts")
    return left.join(right, [key, "_salt"]).drop("_salt")


def may_be_in(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """rows without most of those whose keys wanted doesn't have, so that a join with it shuffles few others.

    wanted's keys set bits of a field of FILTER_BITS; it is broadcast as at most so many / 64
    numbers, however many keys there are: with very many it only lets more rows through.
    """
    at = F.pmod(F.xxhash64(F.lit(17), *keys), F.lit(FILTER_BITS))
    word, bit = F.shiftright(at, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    field = materialize(wanted.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits")), "filter")
    return rows.withColumn("_word", word).join(F.broadcast(field), "_word").where(bit.bitwiseAND(F.col("_bits")) != 0).drop("_word", "_bits")


def ordinals(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with `ordinal`, its row's place (from 0) in an order of all rows; ties have any order.

    One exchange by ranges of the order; partitions are sorted and counted apart, and their first
    places are broadcast, a row for each partition. Rows alike in all of the order stay in one
    partition: end it with a hash of the row where many may be.
    """
    at = F.monotonically_increasing_id()  # a partition's number, then 33 bits of the place in it
    df = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), name).withColumn("_part", F.shiftright("_at", 33))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = df.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_first"))
    return df.join(F.broadcast(first), "_part").withColumn("ordinal", F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_first")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Label each node of the edges (a, b: long) by the least node that it reaches.

    Minimum labels spread along edges, and each round labels also jump to their
    label's label, so long chains shrink by doubling; the least labels only fall, so it
    ends. Every round is a written
    table; only the number of changed rows comes to the driver. Returns
    (node, label). Null ends are ignored; no edges give an empty table.
    """
    e = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = materialize(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), f"{name}-0"
    )
    for k in itertools.count(1):
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        hop = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        now = hop.join(jump, "label", "left").select("node", "old", F.least("label", "far").alias("label"))
        now = materialize(now, f"{name}-{k}")
        labels = now.select("node", "label")
        if now.where("old <> label").isEmpty():
            return labels
