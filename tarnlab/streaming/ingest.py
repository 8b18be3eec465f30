"""Ingest as a stream of files.

The engine's state rules carry over: a content hash is ingested once, corrected data
come as higher revisions, and a batch that is replayed changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.joins import first_by
from ..sources.files import file_rows
from ..warehouse import ingest as batches
from ..warehouse.scratch import written
from ..warehouse.store import TRANSITIONS, Store

#: The source forgets files older than this beside the newest: none in practice.
MAX_AGE = "36500d"
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, path: str, per_batch: int = 1000) -> DataFrame:
    """New files of a folder as a stream, with their content hash."""
    raw = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", per_batch).option("maxFileAge", MAX_AGE).load(path)
    return raw.withColumn("hash", F.sha2("content", 256))


def once_per_hash(batch: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Each content of a batch once (its first path), without those that are known, whenever they came."""
    one = first_by(batch, ["hash"], [F.col("path")])
    return one if known is None else one.join(known.select("hash").distinct(), "hash", "left_anti")


def ingest(stream: DataFrame, checkpoint: str, commit: Callable[[DataFrame, int], None], known: Callable[[], DataFrame | None] = lambda: None) -> None:
    """Run all files that are there through commit(batch, id), then stop.

    known reads the hashes stored so far before each batch, so a content is handed over
    once however late a file of it comes. commit must be idempotent by id: after a failure
    a batch is run again.
    """

    def run(batch: DataFrame, number: int) -> None:
        commit(once_per_hash(batch, known()), number)

    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(run).start()
    query.awaitTermination()


def stream_into(store: Store, path: str, checkpoint: str, per_batch: int = 1000, **options) -> None:
    """Ingest all files that are there into a store, in micro-batches, then stop.

    A batch's name (checkpoint and number) is recorded when it is done, so one that the
    stream repeats is passed over; one that broke off is run again, and what it had
    committed is known by its contents' states, which are written with the rows.
    """
    batches.ensure_schema(store)

    def run(batch: DataFrame, number: int) -> None:
        name = f"{checkpoint}#{number}"
        if store.read("ingest_batch").where(F.col("uuid") == name).isEmpty():
            files = written(file_rows(batch.drop("hash")), "stream-files")
            if not files.isEmpty():
                batches.ingest_files(store, files, path, batch=name, **options)

    query = file_stream(store.spark, path, per_batch).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(run).start()
    query.awaitTermination()


STEPS = "hash string, seq long, old string, new string, legal boolean"


def file_states(reports: DataFrame) -> DataFrame:
    """Reports of files' states (hash, seq from 0, state) as steps in order: hash, seq, old, new, legal.

    Each file's state is kept by its hash. Reports that come again change nothing, those that
    come early wait for the ones before; so in whatever order they come, the steps are the same. An illegal
    step is given with legal false and leaves the state as it was.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        old, due, waiting = kept.get if kept.exists else (None, 0, "{}")
        early = {int(k): v for k, v in json.loads(waiting).items()}
        for f in frames:
            for seq, state in zip(f["seq"].tolist(), f["state"], strict=True):
                if seq >= due:
                    early.setdefault(seq, state)
        out = []
        while due in early:
            new = early.pop(due)
            legal = new == "seen" if old is None else new in TRANSITIONS.get(old, ())
            out.append((key[0], due, old, new, legal))
            old, due = new if legal else old, due + 1
        kept.update((old, due, json.dumps(early)))
        yield pd.DataFrame(out, columns=["hash", "seq", "old", "new", "legal"])

    return reports.groupBy("hash").applyInPandasWithState(step, STEPS, "state string, due long, waiting string", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """An extension: events by type in tumbling windows, closed when the watermark passes."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """An extension: sessions of each user, parted by gaps."""
    return events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
