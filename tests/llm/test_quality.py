import math
import re
from collections import Counter

import xxhash
from conftest_llm import documents

from tarnlab.llm import quality


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    covered = {k for i, w in enumerate(windows) if n[w] > 1 for k in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text):
    """Spark's xxhash64 of words and of pairs of words' hashes, restated."""
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    pack = lambda x: (x & (1 << 64) - 1).to_bytes(8, "little")
    return h + [signed(xxhash.xxh64_intdigest(pack(b), xxhash.xxh64_intdigest(pack(a), 42))) for a, b in zip(h, h[1:], strict=False)]


def test_base_counts(docs, spark):
    got = quality.quality_rules(docs, None).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter((i, *base(t)) for i, t in documents())
    assert all(r.kept == (not r.base_failed) and r.score == 0 for r in got)


def test_ratio(docs, spark):
    labels = spark.createDataFrame([(2, 1, 0), (4, 1, 0), (3, 0, 0), (20, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {(r.doc_id, r.n_words): r for r in quality.quality_rules(docs, labels).collect()}
    n = quality.BUCKETS
    raw, target = Counter(), Counter()
    for i, t in documents():
        b = [g % n for g in grams(t)]
        raw.update(b)
        if i in (2, 4):
            target.update(b)
    sums = sum(raw.values()), sum(target.values())
    ratio = lambda b: round(1e6 * math.log((target[b] + 1) / (sums[1] + n) / ((raw[b] + 1) / (sums[0] + n))))
    for i, t in documents():
        g = grams(t)
        score = sum(ratio(x % n) for x in g) / max(len(g), 1) / 1e6
        r = got[i, base(t)[0]]
        assert math.isclose(r.score, score, abs_tol=1e-9)
        assert r.kept == (not r.base_failed and score >= quality.THRESHOLD)


def test_empty(no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_rules(no_docs, none).count() == 0
