"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs are hashed into buckets. Two multinomials over the buckets,
one of trusted documents and one of the whole corpus, give each bucket a log
ratio; a document's score is the mean over its n-grams, held against a fixed
threshold. Everything is DataFrame expressions: one pass counts, one scores, and
only the bounded bucket table comes to the driver, to be a literal of the plan.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS = 1 << 15
#: Trusted labelled documents that the target is fitted on, at most (those of least hash).
TRUSTED_DOCS = 5000
#: A document is rejected below this mean log ratio per n-gram (nats).
THRESHOLD = -0.2
#: Added to each bucket's count, in occurrences per bucket.
SMOOTHING = 1.0
SCALE = 1_000_000

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 8


def _next(h: Column, by: int) -> Column:
    """Each hash joined with the one `by` places further; null where there is none."""
    return F.zip_with(h, F.slice(h, by + 1, F.size(h)), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(h8: Column) -> Column:
    """Words covered by windows (given by their hashes) that occur twice or more."""
    at = F.array_sort(F.transform(h8, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        same = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        either = _let(same, lambda e: F.zip_with(e, F.concat(F.array(F.lit(False)), e), lambda a, b: F.coalesce(a, F.lit(False)) | b))
        hit = F.zip_with(s, either, lambda a, b: F.when(b, a["i"]))
        starts = F.array_sort(F.filter(hit, lambda i: i.isNotNull()))
        return F.aggregate(
            starts,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    return F.when(F.size(F.array_distinct(h8)) == F.size(h8), F.lit(0)).otherwise(_let(at, covered))


def word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def grams(h: Column, h2: Column) -> Column:
    """Hashes of the words and of their neighbouring pairs."""
    return F.concat(h, F.slice(h2, 1, F.greatest(F.size(h) - 1, F.lit(0))))


def _measured(text: Column, table: Column, buckets: int) -> Column:
    """All counts of a text as one struct: each step is bound once, so a filter on one field doesn't repeat the others."""

    def of_pairs(h: Column, h2: Column) -> Column:
        windows = _let(_next(h2, 2), lambda h4: F.slice(_next(h4, 4), 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))))
        total = F.aggregate(grams(h, h2), F.lit(0).cast("bigint"), lambda a, x: a + F.get(table, F.pmod(x, F.lit(buckets)).cast("int")))
        return F.struct(
            F.size(h).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _let(windows, _repeated_words).cast("long").alias("n_repeat_words"),
            total.alias("total"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return _let(word_hashes(text), lambda h: _let(_next(h, 1), lambda h2: of_pairs(h, h2)))


def log_ratios(docs: DataFrame, labels: DataFrame | None, buckets: int = BUCKETS, trusted_docs: int = TRUSTED_DOCS) -> list[int]:
    """The log ratio of each bucket, in millionths; all 0 without trusted documents."""
    if labels is None:
        return [0] * buckets
    best = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    best = best.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_docs).withColumn("_trusted", F.lit(1))
    rows = docs.select("doc_id", "text").join(F.broadcast(best), "doc_id", "left")
    each = _let(word_hashes(F.col("text")), lambda h: grams(h, _next(h, 1)))
    counted = (
        rows.select("_trusted", F.explode(each).alias("g"))
        .groupBy(F.pmod("g", F.lit(buckets)).alias("bucket"))
        .agg(F.count("*").alias("raw"), F.sum(F.coalesce("_trusted", F.lit(0))).alias("target"))
    )
    found = {r.bucket: (r.raw, r.target) for r in counted.collect()}  # no more rows than buckets
    raw_n, target_n = (sum(x[k] for x in found.values()) for k in (0, 1))
    if not target_n:
        return [0] * buckets
    def ratio(raw: int, target: int) -> int:
        p = (target + SMOOTHING) / (target_n + SMOOTHING * buckets)
        q = (raw + SMOOTHING) / (raw_n + SMOOTHING * buckets)
        return round(SCALE * math.log(p / q))

    return [ratio(*found.get(b, (0, 0))) for b in range(buckets)]


def quality_rules(docs: DataFrame, labels: DataFrame | None, threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """Base counts and the verdict of every row of docs (doc_id, text).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score. A null or empty text has no words, fails the base
    rules and scores 0. Equal texts score alike; repeated rows stay; of the other
    columns those named in carry follow. An id with several texts has a verdict for each.
    A score at the threshold is kept. Very long texts are counted whole. An empty table
    gives an empty result. labels (doc_id, quality, toxic) may be None or empty: then all
    scores are 0 and the base rules alone decide.
    """
    ratios = log_ratios(docs, labels)
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<bigint>")  # folded to a literal
    buckets = len(ratios)
    measured = _measured(F.coalesce("text", F.lit("")), table, buckets)
    df = docs.select("doc_id", measured.alias("_m"), *common.carried(carry))
    m = F.col("_m")
    failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    n_grams = F.greatest(2 * m["n_words"] - 1, F.lit(1))
    out = df.select(
        "doc_id",
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & (m["total"] >= F.lit(round(threshold * SCALE)) * n_grams)).alias("kept"),
        (m["total"] / n_grams / F.lit(SCALE)).alias("score"),
        *(["_carry"] if carry else []),
    )
    return common.uncarried(out, carry)
