import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from conftest_llm import documents

from tarnlab.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def key(doc, text):
    said = ":".join(["0", *([str(doc)] if doc is not None else []), *([text] if text is not None else [])])
    return hashlib.md5(said.encode()).hexdigest()[:15]


def targets(sizes, budget, weights=(5, 2, 1), most=3):
    """Round by round: what is above its cap gets the cap, the others share what is left."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped = set()
    while True:
        left = budget - sum(most * sizes[s] for s in capped)
        rest = sum(w[s] for s in order if s not in capped)
        now = {s: Fraction(most * sizes[s]) if s in capped else Fraction(left * w[s], rest) for s in order}
        over = {s for s in order if now[s] > most * sizes[s]}
        if not over:
            return now
        capped |= over


def expected(rows, per_cent=100):
    by = defaultdict(list)
    for doc, text, source in rows:
        by[source].append((key(doc, text), doc, size_of(text)))
    sizes = {s: sum(n for _, _, n in v) for s, v in by.items()}
    aim = targets(sizes, sum(sizes.values()) * per_cent // 100)
    out = Counter()
    for s, v in by.items():
        passes = aim[s] // sizes[s] if sizes[s] else 0
        need, upto = aim[s] - passes * sizes[s], 0
        for _, doc, n in sorted(v, key=lambda r: r[0]):
            more = n > 0 and upto < need and 2 * (need - upto) >= n
            out[doc, n, sizes[s], round(float(aim[s]), 6), n * (passes + more)] += 1
            upto += n
    return out


def collected(df):
    return Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def sourced():
    names = ["b", "a", None, "", "ä", "z"]
    rows = [(i, t, names[k % 6]) for k, (i, t) in enumerate(documents())]
    return rows + [(100, "hot copy of five words", "a")] * 40 + [(101, None, "only nulls"), (None, "", "only nulls")]


def test_documents(spark, docs):
    rows = sourced()
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "doc_id long, text string, source string, key string, at string, need string").repartition(3)
    got = mixing.mix(df)
    assert collected(got) == expected(rows)
    for r in got.collect():
        assert list(r.taken_by) == sorted(r.taken_by) and r.taken_by[-1] == r.taken <= 3 * r["size"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, mixing.mix(df.repartition(7)).collect()))


def test_many_documents_of_one_source(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(40), "hot" if i % 3 else f"s{i % 11}") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for per_cent in (100, 37):
        got = mixing.mix(df, budgets=(5, per_cent))
        assert collected(got) == expected(rows, per_cent)
        took = defaultdict(int)
        for r in got.collect():
            took[r.source_size, r.target] += r.taken
        assert all(abs(n - target) <= 20 for (_, target), n in took.items())


def test_given_weights(spark):
    df = spark.createDataFrame([(i, "one two", "ab"[i % 2]) for i in range(100)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 3), ("b", 1)], "source string, weight int")
    took = Counter()
    for r in mixing.mix(df, weights).collect():
        took["ab"[r.doc_id % 2]] += r.taken
    assert took == {"a": 150, "b": 50}
    took = Counter()
    for r in mixing.mix(df, weights.where("source = 'a'")).collect():
        took["ab"[r.doc_id % 2]] += r.taken
    assert took == {"a": 200, "b": 0}


def test_empty(no_docs):
    assert mixing.mix(no_docs).count() == 0
