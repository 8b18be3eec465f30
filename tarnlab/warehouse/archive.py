"""Content-addressed archive of source files, and what may be removed once it is there."""

from __future__ import annotations

import contextlib
import posixpath
import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import first_by
from .scratch import written
from .store import Store

ARCHIVE, ASSETS = "archive", "asset"


def archive_files(store: Store, files: DataFrame, kind: str = "Chemical analysis") -> None:
    """Store the bytes of files (hash, filename, content) that the archive doesn't have, with an asset row each: of the file's own type, if they have one."""
    one = first_by(files, ["hash"], [F.col("filename")])
    if store.exists(ARCHIVE):
        one = one.join(store.read(ARCHIVE).select("hash"), "hash", "left_anti")
    with store.transaction():
        store.append(ARCHIVE, one.select(F.col("hash").alias("uuid"), "hash", "content"), "archive", "copy of a source file")
        project = [F.col("uuid_project")] if "uuid_project" in one.columns else []
        of_type = F.coalesce("type", F.lit(kind)) if "type" in one.columns else F.lit(kind)
        asset = one.select(F.concat(F.lit("asset-"), "hash").alias("uuid"), "hash", "filename", of_type.alias("type"), *project)
        store.append(ASSETS, asset, "archive", "archived")


def removable(store: Store, files: DataFrame) -> DataFrame:
    """The files whose archived copy hashes to what their own content does: hash and path."""
    sound = store.read(ARCHIVE).where(F.sha2("content", 256) == F.col("hash")).select("hash")
    return files.where(F.sha2("content", 256) == F.col("hash")).join(sound, "hash", "left_semi").select("hash", "path")


def spent_folders(files: DataFrame, ignorable: Column) -> DataFrame:
    """Folders that hold nothing but ignorable, non-empty files."""
    g = files.groupBy("folder").agg(F.bool_and(F.coalesce(ignorable, F.lit(False)) & (F.col("size") > 0)).alias("spent"))
    return g.where("spent").select("folder")


def _parts(path: str) -> tuple[str, str, str]:
    """Scheme, host and path without dots of a path or URI; a bare path is a file's."""
    scheme, host, name = re.fullmatch(r"(?:(\w+):(?://([^/]*))?)?(/.*)?", path, re.DOTALL).groups()
    return scheme or "file", host or "", posixpath.normpath("/" + (name or "").lstrip("/"))


def inside(path: str, root: str) -> bool:
    """Whether a path, its dots resolved, lies strictly under a root."""
    a, b = _parts(path), _parts(root)
    return a[:2] == b[:2] and a[2] != b[2] and a[2].startswith(b[2].rstrip("/") + "/")


def remove(store: Store, files: DataFrame, root: str) -> int:
    """Delete those of the files (hash, path, content) that lie strictly under root and whose archived copy is sound; how many.

    The rest stays, whoever asks. Every task deletes its own files; a task that is run again counts
    those that it finds deleted, so the number is right in any case.
    """

    def deleted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            mine = [p for p in f["path"] if inside(p, root)]
            for path in mine:
                scheme, host, name = _parts(path)
                system = fs.LocalFileSystem() if scheme == "file" else fs.FileSystem.from_uri(f"{scheme}://{host}/")[0]
                with contextlib.suppress(FileNotFoundError):
                    system.delete_file(name if scheme in ("file", "hdfs") else host + name)
            yield pd.DataFrame({"path": mine}, dtype=object)

    return written(removable(store, files).select("path"), "archive-removable").mapInPandas(deleted, "path string").count()


def remove_spent_folder(store: Store, folder: str, root: str, ignorable: Column) -> bool:
    """Delete a folder strictly under root in which nothing is left but ignorable, non-empty files; whether it went.

    A folder with folders in it is never spent. ignorable is a condition on filename, ext and size.
    """
    if not inside(folder, root):
        return False
    path = store.spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(store.spark._jsc.hadoopConfiguration())
    entries = list(system.listStatus(path))
    if any(e.isDirectory() for e in entries):
        return False
    names = [(folder, e.getPath().getName(), e.getLen()) for e in entries]
    if names:
        left = store.spark.createDataFrame(names, "folder string, filename string, size long")
        left = left.withColumn("ext", F.lower(F.regexp_extract("filename", r"\.([^.]+)$", 1)))
        if spent_folders(left, ignorable).isEmpty():
            return False
    return bool(system.delete(path, True))
