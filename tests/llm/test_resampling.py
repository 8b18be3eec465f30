import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import documents

from tarnlab.llm import resampling


def grams(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def expected(rows, benchmark):
    """With every n-gram written out."""
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, grams(text)[1]))
    for text in benchmark:
        t.update(map(bucket, grams(text)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    scored = []
    for doc, text in rows:
        w, g = grams(text)
        weight = sum(gain(bucket(x)) for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        scored.append((doc, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= 20))
    able = sorted((r for r in scored if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = len(able) * 25 // 100
    out = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return sorted(out + [(*r[:4], None) for r in scored if not r[4]], key=repr)


def collected(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=repr)


BENCHMARK = ["The thonand wheres of ingther", "mañana über straße entre", None, "", "one two THREE 4"]


def test_documents(spark, docs):
    target = spark.createDataFrame([(t, "x") for t in BENCHMARK], "text string, bucket string")
    assert collected(resampling.resample(docs, target)) == expected(documents(), BENCHMARK)


def test_copies_ties_and_partitions(spark):
    rows = [(i // 40, "same words " * 15 if i % 3 else "other words here " * (i % 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    target = spark.createDataFrame([("same words here",)], "text string")
    got = collected(resampling.resample(df, target))
    assert got == expected(rows, ["same words here"])
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, len(ranks) + 1))


def test_empty(spark, no_docs, docs):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(no_docs, none).count() == 0
    assert collected(resampling.resample(docs, none)) == expected(documents(), [])


@pytest.mark.parametrize("lengths", [[0, 1, 2, 3], [7, 64, 255, 256], [1000, 65536, 100_001]])
def test_checksums_of_concatenations(lengths):
    rng = np.random.default_rng(1)
    b = [rng.bytes(n) for n in lengths]
    a = [rng.bytes(k * 3) for k, _ in enumerate(lengths)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    joined = resampling.join(crc(a), crc(b), np.array(lengths))
    assert joined.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b, strict=True)]


def test_longer_runs():
    texts = ["a bb ccc dddd", "x", None, "y " * 5]
    at, whose, words = resampling.features(texts, 10000, 3)
    want = Counter()
    for k, t in enumerate(texts):
        w = (t or "").split()
        for n in (1, 2, 3):
            want.update((k, zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000) for i in range(len(w) - n + 1))
    assert Counter(zip(whose.tolist(), at.tolist(), strict=True)) == want and words.tolist() == [4, 1, 0, 5]
