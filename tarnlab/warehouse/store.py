"""A warehouse of Parquet tables in versioned folders.

A transaction writes new parts of the tables that it changes and then publishes one
pointer file with the next version's number, so readers see all of a commit or nothing. The
pointer names the schema and the parts of every table: an append adds a folder, an update or
delete writes those files anew that hold its rows. Parts never change, so a snapshot is a
pointer that is kept. Paths go through Hadoop's file system, so a store may be wherever Spark
can write and a rename doesn't overwrite.
"""

from __future__ import annotations

import contextlib
import functools
import json
import re
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import first_by
from .scratch import written

POINTERS, SNAPSHOTS = "versions", "snapshots"
LOG = "change_log"
LOG_SCHEMA = "uuid string, tbl string, uuid_row string, field string, old string, new string, action string, actor string, reason string, source_hash string"

# States of a file and where each may go.
TRANSITIONS = {
    "seen": ("claimed", "ignored", "quarantined", "failed"),
    "claimed": ("parsed", "ignored", "quarantined", "failed"),
    "parsed": ("assembled", "ignored", "failed"),
    "assembled": ("reconciled", "ignored", "failed"),
    "reconciled": ("needs_review", "committed", "failed"),
    "needs_review": ("committed", "failed"),
    "committed": ("archived", "failed"),
}


# Whole numbers and fractions by width; a column takes narrower ones.
WIDTHS = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType))


class Conflict(RuntimeError):
    """Another writer has committed since the transaction began."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.staged: dict[str, list[str]] | None = None
        self.schemas: dict[str, str] = {}
        self.base: int = 0

    # files

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        fs, p = self._fs(), self._path(POINTERS)
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdecimal())

    def _content(self, path) -> dict:
        stream = self._fs().open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _pointer(self) -> dict:
        """The pointer of the greatest version: version, and of each table its schema and parts."""
        found = self._versions()
        if not found:
            return {"version": 0, "tables": {}, "schemas": {}}
        return self._content(self._path(POINTERS, f"{found[-1]:012d}"))

    def _publish(self, content: dict, path, *options: str) -> None:
        """Write a pointer aside and rename it to its place, so it is there whole or not at all."""
        fs = self._fs()
        fs.mkdirs(path.getParent())
        tmp = self._path(POINTERS, f".{uuid.uuid4().hex}")
        fs.mkdirs(tmp.getParent())
        out = fs.create(tmp, False)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        array = gateway.new_array(rename, len(options))
        for i, o in enumerate(options):
            array[i] = getattr(rename, o)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(tmp, path, array)
        except Py4JJavaError:
            fs.delete(tmp, False)
            raise

    def _point(self, content: dict) -> None:
        """Publish a version. A rename without overwriting fails if the name is taken, so of two writers of one version one gets a Conflict."""
        try:
            self._publish(content, self._path(POINTERS, f"{content['version']:012d}"))
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"version {content['version']} was written by another") from None
            raise

    # reading

    @property
    def version(self) -> int:
        return self._pointer()["version"]

    def tables(self) -> dict[str, list[str]]:
        return self.staged if self.staged is not None else self._pointer()["tables"]

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads((self.schemas if self.staged is not None else self._pointer()["schemas"])[name]))

    def read(self, name: str) -> DataFrame:
        """A table: its parts together, by the schema of the pointer, so no file is opened for it. Columns that a part lacks are null there."""
        now = {"tables": self.staged, "schemas": self.schemas} if self.staged is not None else self._pointer()
        return self._parts(now["tables"][name], T.StructType.fromJson(json.loads(now["schemas"][name])))

    def _parts(self, parts: list[str], schema: T.StructType) -> DataFrame:
        """Rows of some parts of a table, with its columns."""
        if not parts:  # nothing, known when the plan is made
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
            return self.spark.range(1).select(*none).where(F.lit(False))
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in parts])

    def exists(self, name: str) -> bool:
        return name in self.tables()

    # writing

    @contextlib.contextmanager
    def transaction(self) -> Iterator[Store]:
        """All changes inside become visible together; nested calls join the outer one; an error discards all."""
        if self.staged is not None:
            yield self
            return
        now = self._pointer()
        self.base, self.staged, self.schemas = now["version"], dict(now["tables"]), dict(now["schemas"])
        try:
            yield self
            self._point({"version": self.base + 1, "tables": self.staged, "schemas": self.schemas})
        finally:
            self.staged = None

    def _write(self, name: str, df: DataFrame) -> str:
        folder = f"{name}/v={self.base + 1}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.root}/{folder}")
        return folder

    def _keep(self, name: str, schema: T.StructType) -> None:
        self.schemas[name] = json.dumps(schema.jsonValue())

    def create(self, name: str, schema: str) -> None:
        """A table without rows; nothing is written but the pointer."""
        with self.transaction():
            self.staged[name] = []
            self._keep(name, nullable(T.StructType.fromDDL(schema)))

    def replace(self, name: str, df: DataFrame) -> None:
        """Write a new version of a table, in one part and with the columns of df."""
        with self.transaction():
            self.staged[name] = [self._write(name, df)]
            self._keep(name, nullable(df.schema))

    def _fitted(self, name: str, df: DataFrame) -> DataFrame:
        """df with the types of the table's columns, and the table with the columns that only df has.

        A narrower number or a column of nulls is cast; any other type is refused, before anything is written.
        """
        if not self.exists(name):
            self._keep(name, nullable(df.schema))
            return df
        have = {f.name: f.dataType for f in self.schema(name)}
        for f in nullable(df.schema):
            if f.name in have and not fits(f.dataType, have[f.name]):
                raise TypeError(f"{name}.{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
        new = [f for f in nullable(df.schema) if f.name not in have]
        if new:
            self._keep(name, T.StructType([*self.schema(name), *new]))
        return df.select(*[F.col(f"`{c}`").cast(have[c]).alias(c) if c in have else F.col(f"`{c}`") for c in df.columns])

    def _grow(self, name: str, df: DataFrame) -> DataFrame | None:
        """Add a part with these rows and return it; what is there isn't read or written again. No rows make no part, and None."""
        with self.transaction():
            df = self._fitted(name, df)
            folder = self._write(name, df)
            part = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}")
            some = not part.isEmpty()
            self.staged[name] = [*self.staged.get(name, []), *([folder] if some else [])]
            return part if some else None

    def compact(self, name: str) -> None:
        """Rewrite a table of many parts as one."""
        self.replace(name, self.read(name))

    def append(self, name: str, df: DataFrame, actor: str, reason: str, source_hash: str | None = None) -> None:
        """Add rows and an `insert` log row for each, together."""
        with self.transaction():
            part = self._grow(name, df)  # read back, so the rows aren't made twice
            if part is not None:
                self._log(part.select("uuid"), name, "insert", actor, reason, source_hash)

    def update(self, name: str, changes: DataFrame, actor: str, reason: str, source_hash: str | None = None) -> None:
        """Set fields of rows by uuid: changes has uuid and new values. Unchanged fields aren't logged.

        Every uuid must name exactly one row.
        """
        with self.transaction():
            whole, fields = self.read(name), [c for c in changes.columns if c != "uuid"]
            files = self._holding(name, whole, changes)
            old = self._parts(files, whole.schema)
            types = dict(whole.dtypes)
            for c in fields:
                if c in types and not fits(changes.schema[c].dataType, whole.schema[c].dataType):
                    raise TypeError(f"{name}.{c} is {types[c]}, not {changes.schema[c].dataType.simpleString()}")
            new = changes.select("uuid", *[F.col(c).alias(f"_new_{c}") for c in fields], F.lit(True).alias("_hit"))
            both = old.join(new, "uuid", "left")
            rows = F.stack(F.lit(len(fields)), *[x for c in fields for x in (F.lit(c), F.col(c).cast("string"), F.col(f"_new_{c}").cast("string"))])
            log = both.where("_hit").select("uuid", rows.alias("field", "old", "new")).where(~F.col("old").eqNullSafe(F.col("new")))
            picked = [F.when(F.col("_hit"), F.col(f"_new_{c}").cast(types[c])).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in old.columns]
            self._log(log, name, "update", actor, reason, source_hash)
            self._exchange(name, files, both.select(*picked))

    def delete(self, name: str, uuids: DataFrame, actor: str, reason: str, source_hash: str | None = None) -> None:
        """Delete rows by uuid, logging their values. Every uuid must name exactly one row."""
        with self.transaction():
            whole = self.read(name)
            files = self._holding(name, whole, uuids)
            old = self._parts(files, whole.schema)
            gone = old.join(uuids.select("uuid"), "uuid", "left_semi")
            self._log(gone.select("uuid", F.to_json(F.struct(*old.columns)).alias("old")), name, "delete", actor, reason, source_hash)
            self._exchange(name, files, old.join(uuids.select("uuid"), "uuid", "left_anti"))

    def _holding(self, name: str, table: DataFrame, wanted: DataFrame) -> list[str]:
        """The files of a table that hold the wanted rows; every uuid must be in exactly one row.

        Only uuids and files' names are read.
        """
        if not self.tables()[name]:
            if not wanted.isEmpty():
                raise ValueError(f"{name} has no rows")
            return []
        file = F.regexp_extract(F.col("_metadata.file_path"), rf"/({re.escape(name)}/v=[^/]+/[^/]+)$", 1)
        asked = wanted.groupBy("uuid").agg(F.count("*").alias("n"))
        held = table.select("uuid", file.alias("file")).join(asked.select("uuid"), "uuid", "left_semi")
        found = asked.join(held.groupBy("uuid").agg(F.count("*").alias("m"), F.min("file").alias("file")), "uuid", "left")
        found = written(found, "store-wanted")
        bad = found.where("n <> 1 or coalesce(m, 0) <> 1").limit(5).collect()
        if bad:
            raise ValueError(f"not exactly one row for {[r.uuid for r in bad]}")
        return sorted(r.file for r in found.select("file").distinct().collect())  # names of files, no more than the table has

    def _files(self, part: str) -> list[str]:
        """The data files of a part: itself, or those of a folder."""
        if not re.fullmatch(r".*/v=[^/]+", part):
            return [part]
        names = [f.getPath().getName() for f in self._fs().listStatus(self._path(part))]
        return [f"{part}/{n}" for n in sorted(names) if not n.startswith(("_", "."))]

    def _exchange(self, name: str, files: list[str], rows: DataFrame) -> None:
        """Put rows in the place of some files; the others stay as they are."""
        if not files:
            return
        gone, kept = set(files), []
        touched = {f.rsplit("/", 1)[0] for f in files}
        for part in self.tables()[name]:
            kept += [f for f in self._files(part) if f not in gone] if part in touched or part in gone else [part]
        self.staged[name] = [*kept, self._write(name, rows)]

    def _log(self, rows: DataFrame, name: str, action: str, actor: str, reason: str, source_hash: str | None) -> None:
        have = set(rows.columns)
        part = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
        key = F.sha2(F.concat_ws("|", F.lit(f"{self.base + 1}"), F.lit(name), F.lit(action), "uuid", F.coalesce(part("field"), F.lit(""))), 256)
        log = rows.select(
            key.alias("uuid"), F.lit(name).alias("tbl"), F.col("uuid").alias("uuid_row"), part("field").alias("field"), part("old").alias("old"),
            part("new").alias("new"), F.lit(action).alias("action"), F.lit(actor).alias("actor"), F.lit(reason).alias("reason"),
            F.coalesce(part("source_hash"), F.lit(source_hash).cast("string")).alias("source_hash"),
        )
        self._grow(LOG, log)

    # review queue

    def close_review(self, target: str, kind: str | None, resolution: str, resolved_by: str) -> int:
        """Close all open reviews of a target (of one kind, or any); how many."""
        with self.transaction():
            rows = self.read("review_queue")
            hit = (F.col("status") == "open") & (F.col("uuid_target") == target)
            hit = hit & (F.col("kind") == kind) if kind else hit
            n = rows.where(hit).count()
            if n:
                changes = rows.where(hit).select("uuid", F.lit("closed").alias("status"), F.lit(resolution).alias("resolution"), F.lit(resolved_by).alias("resolved_by"))
                self.update("review_queue", changes, resolved_by, resolution)
            return n

    # snapshots

    def snapshot(self, name: str) -> dict[str, int]:
        """Keep the current version under a name, in the place of an earlier snapshot of that name; rows of each table.

        Every table is counted first, which opens all its files, so a snapshot of what can't be
        read isn't made. The pointer is renamed to its place: an earlier one is there until it is.
        """
        now = self._pointer()
        counts = {t: self._parts(now["tables"][t], T.StructType.fromJson(json.loads(now["schemas"][t]))).count() for t in sorted(now["tables"])}
        self._publish(now | {"counts": counts}, self._path(SNAPSHOTS, name), "OVERWRITE")
        return counts

    def snapshots(self) -> list[str]:
        fs, p = self._fs(), self._path(SNAPSHOTS)
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def prune_snapshots(self, keep: list[str]) -> list[str]:
        """Forget all snapshots but these; their names. No table's data goes."""
        gone = [n for n in self.snapshots() if n not in set(keep)]
        for n in gone:
            self._fs().delete(self._path(SNAPSHOTS, n), False)
        return gone

    def restore(self, name: str) -> None:
        """Publish a snapshot's tables as the next version."""
        then = self._content(self._path(SNAPSHOTS, name))
        with self.transaction():
            self.staged, self.schemas = dict(then["tables"]), dict(then["schemas"])


def fits(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether a column of one type may become one of another without loss."""
    if given == wanted or isinstance(given, T.NullType):
        return True
    return any(type(given) in w and type(wanted) in w and w.index(type(given)) < w.index(type(wanted)) for w in WIDTHS)


def nullable(schema: T.StructType) -> T.StructType:
    """A schema as Parquet gives it back: every column may be null."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def valid_transition(old: Column, new: Column) -> Column:
    """Whether a file may go from one state to another; null (new file) may only be seen."""
    allowed = functools.reduce(lambda a, b: a | b, [(old == s) & new.isin(*to) for s, to in TRANSITIONS.items()])
    return F.coalesce(F.when(old.isNull(), new == "seen").otherwise(allowed), F.lit(False))


def find_or_create(wanted: DataFrame, existing: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """uuid of each distinct key: that of the least existing row, or a new one derived from the key; adds is_new."""
    on = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    first = first_by(existing, keys, [F.col("uuid")]).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("uuid").alias("_uuid"))
    out = wanted.select(*keys).distinct().join(first, on, "left")
    made = F.concat(F.lit(prefix), F.substring(F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256), 1, 32))
    return out.select(*keys, F.coalesce("_uuid", made).alias("uuid"), F.col("_uuid").isNull().alias("is_new"))


def upserted(old: DataFrame, new: DataFrame, key: str = "uuid") -> DataFrame:
    """Rows of new, and those of old whose key new doesn't have."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def commit_outcomes(store: Store, rows: DataFrame, actor: str, reason: str) -> None:
    """Commit rows classified by reconcile.three_way: new ones are inserted, superseding ones update in place.

    The method's constant scales value and limits.
    """
    c = F.coalesce("conversion_constant", F.lit(1.0))
    fields = [(F.col(k) * c).alias(k) for k in ("value", "rl_low")] + [F.col(k) for k in ("value_chr", "quantified", "revision")]
    with store.transaction():
        new = rows.where("outcome = 'new'").select(
            F.concat(F.lit("x"), F.sha2(F.col("row").cast("string"), 256)).alias("uuid"), "uuid_sample", "uuid_lab", *fields
        )
        store.append("analysis", new, actor, reason)
        newer = first_by(rows.where("outcome = 'supersede'"), ["e_uuid"], [F.desc("revision"), F.col("row")])
        if not newer.isEmpty():
            store.update("analysis", newer.select(F.col("e_uuid").alias("uuid"), *fields), actor, reason)


def quarantine_report(files: DataFrame) -> DataFrame:
    """Files that ended in quarantine or failure, latest first."""
    from ..functions import text

    bad = files.where(F.col("state").isin("quarantined", "failed"))
    return bad.withColumn("work_order_guess", text.guess_work_order(F.col("filename"))).orderBy(F.desc("first_seen_at"), "filename")


__all__ = ["Conflict", "Store", "commit_outcomes", "find_or_create", "quarantine_report", "upserted", "valid_transition"]
