"""Target-distribution importance resampling over hashed n-grams, by the algebra of CRC.

A feature is a run of words, its bucket a checksum of its bytes. The checksum of a
concatenation follows from those of its parts: crc(a b) is crc(a), shifted by the length
of b with a matrix over GF(2), xor crc(b). So each word's checksum is computed once, those
of all n-grams are composed from them in arrays, and no n-gram is ever written out.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Buckets of features.
BUCKETS = 10_000
#: The longest run of words that is a feature.
MAX_WORDS = 2
#: Words that a document needs to be drawn, and the share of such documents drawn, in per cent.
LEAST_WORDS, PER_CENT = 20, 25
SEED = 7
SCALE = 1000

#: A-Z are lower-cased beforehand; all bytes from 128 on belong to words.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: The generator polynomial of CRC-32, reflected.
POLYNOMIAL = 0xEDB88320


def _columns_to_tables(columns: np.ndarray) -> np.ndarray:
    """A 32 by 32 matrix (images of single bits) as tables of the images of each of the four bytes."""
    out = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        at = np.arange(256) >> (bit % 8) & 1 == 1
        out[bit // 8, at] ^= columns[bit]
    return out


@cache
def shift_tables(power: int) -> np.ndarray:
    """Tables of the matrix that appends 2 ** power zero bytes to what a checksum stands for."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    if power == 0:
        columns = bits
        for _ in range(8):
            columns = np.where(columns & 1, (columns >> 1) ^ np.uint32(POLYNOMIAL), columns >> 1)
    else:
        half = shift_tables(power - 1)
        columns = _apply(half, _apply(half, bits))
    return _columns_to_tables(columns.astype(np.uint32))


def _apply(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    return tables[0][crcs & 255] ^ tables[1][crcs >> 8 & 255] ^ tables[2][crcs >> 16 & 255] ^ tables[3][crcs >> 24]


def shift(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums after as many zero bytes as lengths say: one matrix for each binary digit of a length."""
    out = crcs.astype(np.uint32)
    left, power = lengths.astype(np.int64), 0
    while left.any():
        odd = np.flatnonzero(left & 1)
        out[odd] = _apply(shift_tables(power), out[odd])
        left, power = left >> 1, power + 1
    return out


def join(a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of concatenations: those of b, `lengths` bytes long, behind those of a."""
    return shift(a, lengths) ^ b


def features(texts: list[str | None], buckets: int = BUCKETS, most: int = MAX_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of some texts, the text of each, and the texts' numbers of words."""
    words: list[bytes] = []
    counts = []
    for t in texts:
        found = WORD.findall((t or "").encode().lower())
        words += found
        counts.append(len(found))
    n = np.array(counts, np.int64)
    of = np.repeat(np.arange(len(texts)), n)
    crcs = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    space = np.full(len(words), zlib.crc32(b" "), np.uint32)
    spaced = join(space, crcs, lengths)  # of a space and the word
    out, whose = [crcs % buckets], [of]
    grams = crcs
    for k in range(1, most):
        ends = np.arange(k, len(words))
        grams = join(grams[: len(ends)], spaced[k:], lengths[k:] + 1)  # the run that ends k words on
        inside = of[ends] == of[ends - k]
        out.append(grams[inside] % buckets)
        whose.append(of[ends][inside])
    return np.concatenate(out), np.concatenate(whose), n


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = MAX_WORDS) -> np.ndarray:
    """Features in each bucket, over all rows of a table with a column text.

    Tasks sum their own rows, Spark sums the tasks' buckets; `buckets` numbers come to the driver.
    """
    common.small_batches(texts.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, rows in common.text_rows(batches):
            total += np.bincount(features(rows, buckets, most)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = texts.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray, scale: int = SCALE) -> list[int]:
    """Each bucket's log-likelihood gain of the target over the raw texts, one added to each bucket; whole numbers."""
    s_all, t_all, n = int(raw.sum()), int(target.sum()), len(raw)
    ratio = lambda s, t: (float(t + 1) * float(s_all + n)) / (float(s + 1) * float(t_all + n))
    return [math.floor(scale * math.log(ratio(s, t))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)]


def noise(doc_id: int | None, seed: int = SEED, scale: int = SCALE) -> int:
    """A whole number from a Gumbel distribution that only seed and id decide."""
    said = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(said.encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: list[int], seed: int = SEED, most: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_features, weight and score of every document, and `drawable`, whether it has LEAST_WORDS words."""
    common.small_batches(docs.sparkSession)
    per_bucket = np.array(gain, np.int64)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in common.text_rows(batches):
            at, whose, words = features(rows, len(per_bucket), most)
            n = np.bincount(whose, minlength=len(rows))
            total = np.zeros(len(rows), np.int64)
            np.add.at(total, whose, per_bucket[at])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            score = weight + np.array([noise(d, seed) for d in batch.column("doc_id").to_pylist()], np.int64)
            columns = [batch.column("doc_id"), pa.array(n), pa.array(weight), pa.array(score), pa.array(words >= LEAST_WORDS)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "weight", "score", "drawable"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(weighed, "doc_id long, n_features long, weight long, score long, drawable boolean")


def resample(docs: DataFrame, target: DataFrame, per_cent: int = PER_CENT, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Draw documents that resemble the target's texts, without putting back.

    docs: doc_id and text; target: text. Both are counted whole. Returns doc_id, n_features,
    weight (the floored mean gain of its features), score (weight and noise) and rank (1 for
    the highest score; null for documents that aren't drawn) of every document. Ties go to
    the smaller id, null last, then to fewer features; rows alike in all of that have ranks of
    their own. A text that is null or without words has no features and weight 0. No documents
    give no rows; without a target all counts of it are 0. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    facts = common.materialize(weigh(docs, gain, seed), "resampled")
    drawn = facts.where("drawable").count() * per_cent // 100
    tie = F.xxhash64(F.monotonically_increasing_id())
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("_tie").asc()]
    placed = common.ordinals(facts.where("drawable").withColumn("_tie", tie), order, "resampled-order")
    rank = (F.col("ordinal") + 1).cast("long")
    columns = ["doc_id", "n_features", "weight", "score"]
    placed = placed.select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    rest = facts.where("not drawable").select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed.unionByName(rest)
