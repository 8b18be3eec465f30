import hashlib
import zlib
from collections import Counter, defaultdict

from conftest_llm import documents

from tarnlab.llm import sharding


def key(i, t):
    h = lambda s, n: int(hashlib.md5(s.encode()).hexdigest()[:n], 16)
    return h(t or "", 8) * (1 << 28) + h("" if i is None else str(i), 7)


def expected(rows, shards):
    size = lambda t: len((t or "").encode()) + 1
    total = sum(size(t) for _, t in rows)
    by = defaultdict(list)
    for i, t in rows:
        by[key(i, t)].append((i, t))
    below, out, slots = 0, {}, Counter()
    for k in sorted(by):
        s = min(shards - 1, shards * below // total)
        for i, t in sorted(by[k], key=lambda r: (r[0] is not None, r[0] or 0)):
            out.setdefault((i, size(t), zlib.crc32((t or "").encode())), []).append((s, slots[s]))
            slots[s] += 1
        below += sum(size(t) for _, t in by[k])
    return {k: sorted(v) for k, v in out.items()}


def collected(df):
    out = defaultdict(list)
    for r in df.collect():
        assert r.law == "bytes" and r.grown_shard is None
        out[r.doc_id, r["size"], r.text_crc32].append((r.shard, r.slot))
    return {k: sorted(v) for k, v in out.items()}


def test_documents(docs):
    assert collected(sharding.shard_rows(docs, 4)) == expected(documents(), 4)


def test_hot_group_and_many_ranges(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i} " * (i % 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collected(sharding.shard_rows(df, 16, ranges=64))
    assert got == expected(rows, 16)
    bytes_of = Counter()
    for (_, size, _), places in got.items():
        for s, _ in places:
            bytes_of[s] += size
    mean = sum(bytes_of.values()) / 16
    assert len(bytes_of) == 16 and max(abs(b - mean) for b in bytes_of.values()) < 200


def test_empty(no_docs):
    assert sharding.shard_rows(no_docs).count() == 0
