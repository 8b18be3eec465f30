import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import documents
from tokenizers import Tokenizer

from tarnlab.llm import packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.WORD_BPE)


def test_words_as_the_library_has_them(tokenizer):
    own = packing.WordTokenizer(queries.WORD_BPE)
    rng = random.Random(6)
    pools = ["abc XYZ's", "it's we'LL 12 ½²", "éÉßñ ×÷", "日本 é İ ſ K", "!!' .-\t\n", "<|endoftext|> a", "<|endoftext|><|startoftext|><|ENDOFTEXT|>", "\x1c\x85\xa0 b"]
    texts = ["<|endoftext|>", "x<|endoftext|>y<|startoftext|>", *("".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(40))) for _ in range(3000))] + [t or "" for _, t in documents()]
    texts += ["a<|endoftext|>日本<|endoftext|>" + t for t in texts[:200]]
    for t in texts:
        assert np.frombuffer(own(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t[:80])


def test_pieces(docs, tokenizer):
    got = packing.pack_documents(docs, queries.WORD_BPE).collect()
    ids = defaultdict(list)
    for i, t in documents():
        ids[i].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END], "<u4"))
    for i, expected in ids.items():
        want = Counter(len(x) for x in expected)
        parts = [r for r in got if r.doc_id == i]
        whole = Counter()
        for r in parts:
            whole[r.doc_tokens] += r.length
            assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in expected)
        assert whole == Counter({n: n * k for n, k in want.items()})
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    total = sum(r.length for r in got)
    for p in places.values():
        at = 0
        for offset, n in sorted(p):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
    assert len(places) == -(-total // packing.LENGTH)


def test_pack_covers_each_token_once():
    rng = random.Random(7)
    for _ in range(30):
        lengths = [(i, rng.choice([1, 5, 64, 100, 129, 400, int(rng.expovariate(1 / 60)) + 1])) for i in range(rng.randrange(1, 200))]
        pieces = packing.pack(lengths, 128)
        by = defaultdict(list)
        for row, start, n, _, _ in pieces:
            by[row].append((start, n))
        for row, n in lengths:
            at = 0
            for start, k in sorted(by[row]):
                assert start == at and k > 0
                at += k
            assert at == n
        assert len({p[3] for p in pieces}) <= -(-sum(n for _, n in lengths) // 128) + 1


def test_costs_are_balanced():
    rng = random.Random(9)
    lengths = [(i, rng.randrange(1, 400)) for i in range(5000)]
    spent = defaultdict(float)
    for _, _, n, s, _ in packing.pack(lengths, 2048):
        spent[s] += packing.cost(n)
    v = np.array(list(spent.values()))
    assert v.max() / v.mean() < 1.05


def test_several_groups(docs):
    got = packing.pack_documents(docs, queries.WORD_BPE, group_tokens=5000).collect()
    assert len({r.sequence_id >> 40 for r in got}) > 1
    assert sum(r.length for r in got) == sum(r.length for r in packing.pack_documents(docs, queries.WORD_BPE).collect())


def test_empty(no_docs):
    assert packing.pack_documents(no_docs, queries.WORD_BPE).count() == 0


def plainly(lengths, length):
    """The assignment rule restated: the longest rest first, to the cheapest sequence with room, else cut to fill the emptiest."""
    whole = [(row, start, length) for row, n in sorted(lengths) for start in range(0, n - length + 1, length)]
    rest = [(n % length, row, n - n % length) for row, n in lengths if n % length]
    sequences = [[] for _ in range(-(-sum(n for n, _, _ in rest) // length))]
    room = lambda s: length - sum(s)
    spent = lambda s: sum(packing.cost(n) for n in s)
    out = []
    while rest:
        rest.sort(key=lambda x: (-x[0], x[1]))
        n, row, start = rest.pop(0)
        open_to = [i for i, s in enumerate(sequences) if room(s) >= n]
        if open_to:
            i, take = min(open_to, key=lambda i: (spent(sequences[i]), i)), n
        else:
            i = max(range(len(sequences)), key=lambda i: (room(sequences[i]), -i))
            take = room(sequences[i])
            rest.append((n - take, row, start + take))
        out.append((row, start, take, i, length - room(sequences[i])))
        sequences[i].append(take)
    return [(row, start, n, k, 0) for k, (row, start, n) in enumerate(whole)] + [(row, start, n, i + len(whole), at) for row, start, n, i, at in out]


def test_assignment_restated():
    rng = random.Random(12)
    for _ in range(60):
        lengths = [(i, rng.choice([1, 2, 3, rng.randrange(1, 40), rng.randrange(1, 150)])) for i in range(rng.randrange(0, 40))]
        assert packing.pack(lengths, 32) == plainly(lengths, 32)


def test_groups_are_bounded_in_rows(spark, docs):
    one, many = (packing.pack_documents(docs, queries.WORD_BPE, group_rows=k) for k in (1 << 20, 5))
    assert {r.sequence_id >> 40 for r in one.collect()} == {0} and len({r.sequence_id >> 40 for r in many.collect()}) > 2
    count = lambda df: sorted((str(r.doc_id), r.n) for r in df.groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect())
    assert count(one) == count(many)
