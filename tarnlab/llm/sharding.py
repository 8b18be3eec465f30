"""Sharding by histogram sort.

Rows are ordered by a key; splitters of that order give every shard the same
bytes. Each round counts exactly, over all partitions, the bytes and rows that
lie below the candidate boundaries of a bounded set of key ranges, keeps the
ranges in which a splitter (or too many rows) lies and probes those more finely,
until every splitter meets its tolerance. Then the rows are exchanged once, by
ranges small enough to sort, whose first slots are known from the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHARDS = 16
#: Bytes by which a splitter may miss its target where a finer boundary exists.
TOLERANCE = 0
#: Ranges of the final exchange, about; no range holds more than twice this share of rows unless one key does.
RANGES = 256
#: Bits of the first probes, and of each refinement.
FIRST_BITS, STEP_BITS, KEY_BITS = 12, 6, 60


def sort_key(text: Column, doc_id: Column) -> Column:
    """60 bits: 32 of the text's digest, so equal texts are neighbours, then 28 of the id's, which part large groups."""
    part = lambda c, n: F.conv(F.substring(F.md5(c), 1, n), 16, 10).cast("bigint")
    return part(text, 8) * (1 << 28) + part(doc_id.cast("string"), 7)


def _counts(keyed: DataFrame, ranges: dict[int, list[int]], bits: int, step: int) -> list:
    """Exact bytes and rows of each sub-range of the open ranges.

    ranges: prefixes of `bits` bits; each is cut by the next `step` bits.
    """
    prefix = F.shiftright("k", KEY_BITS - bits - step)
    rows = keyed
    if bits:
        wanted = common.literal_rows(keyed.sparkSession, [(p,) for p in ranges], "p:bigint")  # at most 2 * RANGES + SHARDS rows
        rows = keyed.join(F.broadcast(wanted), F.shiftright("k", KEY_BITS - bits) == F.col("p"), "left_semi")
    return rows.groupBy(prefix.alias("at")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()


def split(keyed: DataFrame, shards: int, tolerance: int = TOLERANCE, ranges: int = RANGES) -> list[tuple[int, int, int, int]]:
    """Ranges in key order: (first key, key after the last, shard, first slot).

    keyed: size and k of all rows. A row belongs to the shard in which the bytes
    before its key fall; rows of one key stay together.
    """
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    if not total.rows:
        return []
    most_rows = max(1, 2 * total.rows // ranges)
    shard_at = lambda below: min(shards - 1, shards * below // total.bytes)

    def settled(below: int, size: int) -> bool:
        """Whether all rows of a range may share the shard of its first byte."""
        first, last = shard_at(below), shard_at(below + size - 1)
        nearest = -(-total.bytes * (first + 1) // shards)
        return first == last or last == first + 1 and below + size - nearest <= tolerance

    done: list[tuple[int, int, int, int]] = []  # first key, width in bits, bytes, rows
    todo: dict[int, list[int]] = {0: []}
    bits, before, step = 0, {0: 0}, FIRST_BITS
    while todo:
        found: dict[int, list[tuple[int, int, int]]] = {}
        for r in _counts(keyed, todo, bits, step):
            found.setdefault(r["at"] >> step, []).append((r["at"], r["bytes"], r["rows"]))
        bits, finer, finer_before = bits + step, {}, {}
        for parent, parts in found.items():
            below = before[parent]
            for at, size, rows in sorted(parts):
                if bits < KEY_BITS and rows > 1 and (rows > most_rows or not settled(below, size)):
                    finer[at], finer_before[at] = [], below
                else:
                    done.append((at << (KEY_BITS - bits), KEY_BITS - bits, size, rows))
                below += size
        todo, before, step = finer, finer_before, STEP_BITS
    out, below, slot, last = [], 0, 0, 0
    for first, width, size, rows in sorted(done):
        shard = shard_at(below)
        slot = slot if shard == last else 0
        last = shard
        if out and out[-1][2] == shard and out[-1][4] + rows <= most_rows:  # small neighbours sort together
            a, _, s, at, n = out[-1]
            out[-1] = (a, first + (1 << width), s, at, n + rows)
        else:
            out.append((first, first + (1 << width), shard, slot, rows))
        below, slot = below + size, slot + rows
    return [x[:4] for x in out]


def shard_rows(df: DataFrame, shards: int = SHARDS, tolerance: int = TOLERANCE, ranges: int = RANGES) -> DataFrame:
    """Put every row of df (doc_id, text) into a shard, law `bytes`: sizes as near equal as keys allow.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot (gapless
    from 0 in key order within the shard), grown_shard (null: only the law `key` has
    it). A null text has no bytes and counts 1; its checksum is that of no bytes.
    Null ids sort as the empty string. Rows alike in id and text share a key, so a
    shard, and take neighbouring slots. Groups of equal texts are neighbours too, but a
    large one is cut at a shard's boundary by the ids: law `bytes` wants equal sizes, and
    a group of a third of all bytes would fill five shards. Very long texts count whole:
    one longer than a shard's share makes that shard the larger. An empty table gives an empty result; other
    columns are ignored.
    """
    spark = df.sparkSession
    text = F.coalesce("text", F.lit(""))
    keyed = df.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        sort_key(text, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("k"),
    )
    keyed = common.materialize(keyed, "shard-keys")  # each round reads two narrow columns of it
    cut = split(keyed.select("size", "k"), shards, tolerance, ranges)
    # ranges by the key's first bits: one row per prefix, and the few boundaries within it
    shift = KEY_BITS - FIRST_BITS
    by_prefix: dict[int, list[tuple[int, int]]] = {}
    at = 0
    for prefix in range(1 << FIRST_BITS):
        low, high = prefix << shift, (prefix + 1) << shift
        while at + 1 < len(cut) and cut[at + 1][0] <= low:
            at += 1
        inner = []
        k = at + 1
        while k < len(cut) and cut[k][0] < high:
            inner.append(cut[k][0])
            k += 1
        by_prefix[prefix] = (at, inner)
    where = common.literal_rows(spark, [(p, a, b) for p, (a, b) in by_prefix.items()], "prefix:bigint,base:int,inner:array<bigint>")
    parts = common.literal_rows(spark, [(i, s, slot) for i, (_, _, s, slot) in enumerate(cut)], "part:int,shard:int,first:bigint")
    placed = (
        keyed.join(F.broadcast(where), F.shiftright("k", shift) == F.col("prefix"))
        .withColumn("part", F.col("base") + F.size(F.filter("inner", lambda b: b <= F.col("k"))))
        .join(F.broadcast(parts), "part")
    )
    rank = F.row_number().over(Window.partitionBy("part").orderBy("k", "doc_id")) - 1
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + rank).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
