"""Mixing sources to target weights by hash-threshold histograms.

Every document has a place in its source, a hash. A source's target is some whole
passes over it and a remainder; the documents below a threshold of the hash are taken
once more. Sizes are summed by source and hash bucket; the bucket in which the
remainder falls is refined, and no other, until it holds one document. Then all rows
are filtered by their source's thresholds. Nothing is sorted, and budgets nest: what
a smaller one takes, a greater one takes too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Weights of the sources in order of code points, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its size.
MOST_PASSES = 3
#: Bits of one histogram, and its rounds over the hash and then over the row.
STEP_BITS, STEPS = 12, 5
KEY_BITS = STEP_BITS * STEPS
#: Shares of all sizes that budgets are set for, in per cent; the last is the mix.
BUDGETS = (25, 50, 100)

WORD = r"[^\x20\x09-\x0D]+"


def _facts(docs: DataFrame, seed: int) -> DataFrame:
    """One short row for each document, written once: texts are read no more."""
    said = F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text"))
    facts = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(said), 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
    )
    # only rows alike in id and text share a key; which of them is taken makes no difference
    facts = facts.withColumn("tie", F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - KEY_BITS))
    return common.materialize(facts.withColumn("at", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), "mix-facts")


def cycled(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sources with a weight each: these by turns, in order of code points, null last."""
    out = common.ordinals(sources, [F.col("source").asc_nulls_last()], "mix-order")
    return out.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("ordinal", F.lit(len(weights))) + 1).cast("int"))).drop("ordinal")


def targets(sources: DataFrame, budgets: list[int], most: int = MOST_PASSES) -> DataFrame:
    """sources (source_size, weight) with `targets`, one for each budget of words.

    A budget is shared by weight; what a source would get beyond `most` times its size is
    shared among the others, until none is above. The shares only grow, so that ends;
    a round costs one aggregate, whose two numbers for each budget come to the driver.
    """
    big = lambda x: F.lit(x).cast("decimal(38,0)") if isinstance(x, int) else x.cast("decimal(38,0)")
    cap = F.col("source_size") * most

    def above(left: int, weight: int) -> Column:
        return big(cap) * big(weight) < big(left) * big(F.col("weight"))

    now = [(b, None) for b in budgets]
    while True:
        sums = []
        for k, (left, weight) in enumerate(now):
            over = F.lit(False) if weight is None else above(left, weight)
            sums += [F.sum(F.when(over, cap).otherwise(0)).alias(f"c{k}"), F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias(f"w{k}")]
        got = sources.agg(*sums).first()
        new = [(b - (got[f"c{k}"] or 0), got[f"w{k}"] or 0) for k, b in enumerate(budgets)]
        if new == now:
            break
        now = new
    share = lambda left, weight: F.lit(float(left)) * F.col("weight") / F.lit(float(max(weight, 1)))
    each = [F.when(above(a, w), cap.cast("double")).otherwise(share(a, w)) if w else cap.cast("double") for a, w in now]
    return sources.withColumn("targets", F.array(*each))


def _thresholds(facts: DataFrame, needs: DataFrame) -> DataFrame:
    """The exclusive upper key (high, low) of each need (at, budget, need > 0): rows below it sum to nearly that.

    The bucket in which a need falls is refined until it holds one row, which is taken if
    that brings the sum nearer (or as near).
    """
    rows = facts.where("size > 0")
    width = (1 << STEP_BITS) - 1
    opened = needs.select("at", "budget", "need", F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"))
    done = []
    for step in range(2 * STEPS):
        part, k = ("key", step) if step < STEPS else ("tie", step - STEPS)
        shift = KEY_BITS - STEP_BITS * (k + 1)
        digit = F.shiftright(part, shift).bitwiseAND(F.lit(width)).alias("digit")
        fixed = [(F.shiftright("key", KEY_BITS - STEP_BITS * min(step, STEPS)) if step else F.lit(0).cast("long")).alias("high")]
        fixed += [(F.shiftright("tie", KEY_BITS - STEP_BITS * k) if part == "tie" and k else F.lit(0).cast("long")).alias("low")]
        seen = rows.select("at", *fixed, digit, "size")
        if step:  # the rows of the buckets in which needs fall: a few thousandths of the last round's
            seen = seen.join(opened.select("at", "high", "low").distinct(), ["at", "high", "low"], "left_semi")
        counts = seen.groupBy("at", "high", "low", "digit").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        w = Window.partitionBy("at", "high", "low").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)  # at most 4,096 buckets
        counts = counts.withColumn("upto", F.sum("words").over(w))
        hit = counts.join(opened, ["at", "high", "low"]).where("upto - words < need and need <= upto")
        hit = hit.withColumn("need", F.col("need") - F.col("upto") + F.col("words"))
        deeper = lambda c: F.shiftleft(c, STEP_BITS) + F.col("digit")
        hit = hit.withColumn(*(("high", deeper("high")) if part == "key" else ("low", deeper("low"))))
        hit = common.materialize(hit.select("at", "budget", "need", "high", "low", "words", "n"), f"mix-{step}")
        last = F.col("n") == 1 if step < 2 * STEPS - 1 else F.lit(True)
        more = F.when(2 * F.col("need") >= F.col("words"), 1).otherwise(0).cast("long")
        high = F.shiftleft(F.col("high") + more, shift) if part == "key" else F.col("high")
        low = F.shiftleft(F.col("low") + more, shift) if part == "tie" else F.lit(0).cast("long")
        done.append(hit.where(last).select("at", "budget", high.alias("high"), low.alias("low")))
        opened = hit.where(~last).drop("words", "n")
        if opened.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] | DataFrame = WEIGHTS, budgets: tuple[int, ...] = BUDGETS, most: int = MOST_PASSES, seed: int = 0) -> DataFrame:
    """How many words each document gives to a mix of sources, for nested budgets.

    docs: doc_id, text, source; other columns are ignored. weights: by turns in the
    sources' order, or a table (source, weight: int) with one row for each source; a source
    that it lacks has weight 0. budgets: rising per cents of all words.

    Returns doc_id, size, source_size, target (its source's, of the last budget), taken
    (words, whole documents, of the last budget) and taken_by (of each budget). A source's
    taken words miss its target by at most half of one document. A null text has size 0 and
    gives nothing; null is a source of its own, and so is the empty string; the id may be null or repeat. Of
    rows alike in id and text as many are taken as come nearest. No documents give no rows.
    """
    facts = _facts(docs, seed)
    sources = facts.groupBy("at", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("at"), F.col("weight").cast("int").alias("weight"))
        sources = common.materialize(sources.join(given, "at", "left").fillna({"weight": 0}), "mix-sources")
    else:
        sources = common.materialize(cycled(sources, weights), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    shared = common.materialize(targets(sources, [total * b // 100 for b in budgets], most), "mix-targets")

    each = shared.select("at", "source_size", F.posexplode("targets").alias("budget", "target")).where("source_size > 0")
    each = each.withColumn("passes", F.floor(F.col("target") / F.col("source_size")))
    each = each.withColumn("need", F.least(F.col("target") - F.col("passes") * F.col("source_size"), F.col("source_size").cast("double")))
    each = common.materialize(each, "mix-needs")
    cuts = _thresholds(facts, each.where("need > 0"))
    plan = each.join(cuts, ["at", "budget"], "left").select("at", "budget", F.struct("budget", "passes", "high", "low").alias("cut"))
    plan = plan.groupBy("at").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))  # one entry for each budget
    dim = shared.join(plan, "at", "left").select("at", "rows", "source_size", F.element_at("targets", -1).alias("target"), "cuts")
    dim = common.materialize(dim, "mix-plan")

    below = lambda c: (F.col("key") < c["high"]) | ((F.col("key") == c["high"]) & (F.col("tie") < c["low"]))
    taken = F.transform("cuts", lambda c: F.col("size") * (c["passes"] + F.when(below(c), 1).otherwise(0)))
    nothing = F.array_repeat(F.lit(0).cast("long"), len(budgets))
    out = common.hot_join(facts.drop("source"), dim, "at", drop="rows").withColumn("taken_by", F.coalesce(taken, nothing))
    return out.select("doc_id", "size", "source_size", "target", F.element_at("taken_by", -1).alias("taken"), "taken_by")
