"""Files as rows: metadata, decoding with fallback, and routing to adapters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

PEEK_BYTES = 2048

# Files that are never routed, and tiers of claims from strong to weak.
IGNORED_EXTENSIONS = ("bak", "tmp", "ds_store")
TIERS = ("exact", "format", "fallback")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file directly in a folder: hash, path, folder, filename, ext, size, content, peek, guesses."""
    return file_rows(spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path))


def file_rows(raw: DataFrame) -> DataFrame:
    """Binary files (path, length, content) with what is known of each before it is read."""
    name = F.element_at(F.split("path", "/"), -1)
    df = raw.select(
        F.sha2("content", 256).alias("hash"), "path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), name.alias("filename"),
        F.col("length").alias("size"), "content",
    )
    ext = F.lower(F.regexp_extract("filename", r"\.([^.]+)$", 1))
    peek = F.translate(F.decode(F.substring("content", 1, PEEK_BYTES), "ISO-8859-1"), "\0", "")
    return df.select(
        "*", ext.alias("ext"), peek.alias("peek"), text.guess_work_order(F.col("filename")).alias("work_order_guess"),
        text.guess_revision(F.col("filename")).alias("revision_guess"),
    )


def damage(c: Column) -> Column:
    """How many spellings of the replacement character a text still holds after the repairs."""
    fixed = text.normalise_lab_text(c)
    return sum((F.size(F.split(fixed, x, -1)) - 1 for x in ("�", "<ef><bf><bd>", "ï¿½")), F.lit(0))


def decoded(content: Column, primary: str = "UTF-8", alternate: str = "ISO-8859-1") -> Column:
    """The text under the primary encoding, unless the alternate has as many lines and less damage."""
    read = {
        e: F.decode(content, e) if e != "UTF-8" else F.coalesce(F.try_validate_utf8(content.cast("string")), F.make_valid_utf8(content.cast("string")))
        for e in (primary, alternate)
    }
    a, b = read[primary], read[alternate]
    lines = lambda c: F.size(F.split(c, "\n", -1))
    return text.strip_bom(F.when((lines(a) == lines(b)) & (damage(b) < damage(a)), b).otherwise(a))


def ignore_reason(ext: Column, filename: Column, size: Column) -> Column:
    return (
        F.when(ext.isin(*IGNORED_EXTENSIONS), F.concat(F.lit("ignored_extension:"), ext))
        .when(filename == ".DS_Store", "ds_store_file")
        .when(size == 0, "empty_file")
    )


@dataclass(frozen=True)
class Adapter:
    """A user-defined source: how strongly it claims a file (a tier or null), and how it parses files."""

    id: str
    version: str
    match: Callable[[DataFrame], Column]
    parse: Callable[[DataFrame], DataFrame] | None = None


class Registry:
    def __init__(self):
        self.adapters: dict[str, Adapter] = {}

    def register(self, adapter: Adapter) -> None:
        if adapter.id in self.adapters:
            raise ValueError(f"adapter {adapter.id} is registered already")
        self.adapters[adapter.id] = adapter

    def ids(self) -> list[str]:
        return sorted(self.adapters, key=str.encode)

    def clear(self) -> None:
        self.adapters.clear()


def claims(files: DataFrame, registry: Registry) -> DataFrame:
    """Every file with every adapter's tier (null: no claim): the router's matrix, in long form."""
    each = [F.struct(F.lit(f"{i}/{registry.adapters[i].version}").alias("adapter"), registry.adapters[i].match(files).alias("tier")) for i in registry.ids()]
    return files.select("hash", "filename", F.explode(F.array(*each)).alias("_c")).select("hash", "filename", "_c.adapter", "_c.tier")


def route(files: DataFrame, matrix: DataFrame) -> DataFrame:
    """hash, state and reason of each file: ignored, claimed by the only adapter of the best tier, or quarantined.

    Of files with the same content the first path counts.
    """
    rank = F.lit(None).cast("int")
    for i, t in enumerate(TIERS):
        rank = F.when(F.col("tier") == t, i).otherwise(rank)
    best = (
        matrix.withColumn("rank", rank).where("rank is not null").groupBy("hash", "rank").agg(F.collect_set("adapter").alias("adapters"))
        .groupBy("hash").agg(F.min(F.struct("rank", "adapters")).alias("best"))
    )
    one = files.groupBy("hash").agg(F.min(F.struct("filename", "ext", "size")).alias("f"))
    reason = ignore_reason(F.col("f.ext"), F.col("f.filename"), F.col("f.size"))
    out = one.join(best, "hash", "left").withColumn("_r", reason)
    n = F.size("best.adapters")
    return out.select(
        "hash",
        F.col("f.filename").alias("filename"),
        F.when(F.col("_r").isNotNull(), "ignored").when(F.col("best").isNotNull() & (n == 1), "claimed").otherwise("quarantined").alias("state"),
        F.coalesce("_r", F.when(F.col("best").isNull(), "unclaimed").when(n > 1, "adapter_tie")).alias("reason"),
        F.when(F.col("_r").isNull() & (n == 1), F.col("best.adapters")[0]).alias("adapter"),
    )


def is_reconsidered(state: Column, reason: Column) -> Column:
    """Whether a stored outcome may change when adapters do."""
    return F.coalesce((state == "failed") | reason.isin("unclaimed", "adapter_tie"), F.lit(False))
