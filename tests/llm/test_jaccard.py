import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import documents, sentence

from tarnlab.llm import common, jaccard


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows))


def test_components(docs):
    got = jaccard.jaccard_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(tuple(r) for r in got.collect()) == brute(documents())


def test_empty(no_docs):
    assert jaccard.jaccard_components(no_docs).count() == 0


def edited_copies():
    """A large group of near copies, links only through third documents, and a common passage."""
    rng = random.Random(8)
    base = sentence(rng, 90).split()
    passage = sentence(rng, 40)
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    return rows + [(100 + i, passage + " " + sentence(rng, rng.randrange(5, 30))) for i in range(40)]


@pytest.mark.parametrize("tile", [4, 4096])
def test_edited_copies_and_tiles(spark, monkeypatch, tile):
    """Also with cells of several tiles and turns, hot keys and all shingles in one bucket."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(common, "HOT_ROWS", tile)
    monkeypatch.setattr(common, "HOT_KEYS", 10_000)
    rows = edited_copies()
    if tile == 4:
        monkeypatch.setattr(jaccard, "bucket_levels", lambda seen: np.zeros(jaccard.BUCKETS, np.uint8))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_same_id_with_other_texts(spark):
    """One row of each class stays, whole, whatever the ids of the others."""
    rng = random.Random(2)
    a, b, c = (sentence(rng, 50) for _ in range(3))
    rows = [(2, a, "x"), (5, a, "y"), (5, b, "z"), (7, c, "q"), (7, c, "p"), (None, a, "n"), (None, "", "e"), (None, None, "f"), (9, None, "g"), (9, None, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    assert Counter(map(tuple, jaccard.one_of_each(df).collect())) == Counter(
        [(2, a, "x"), (5, b, "z"), (7, c, "p"), (None, "", "e"), (None, None, "f"), (9, None, "g"), (9, None, "g")]
    )
    assert jaccard.one_of_each(df.limit(0)).count() == 0


def test_linked_sets_share_a_rare_shingle():
    rng = np.random.default_rng(4)
    for _ in range(3000):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        cut = int(rng.integers(0, max(1, n // 5)))
        more = rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 5))), dtype=np.uint64)
        b = np.unique(np.concatenate([a[cut:], more]))
        levels = rng.integers(0, 4, jaccard.BUCKETS).astype(np.uint8)
        if jaccard.links(a, b):
            assert np.intersect1d(jaccard.prefix(a, levels), jaccard.prefix(b, levels)).size


@pytest.mark.parametrize("length", [100, 2500])  # the long ones go through the sharper bound too
def test_cell_gives_fewer_links_than_rows(length):
    rng = random.Random(6)
    texts = []
    for _ in range(3):
        base = sentence(rng, length).split()
        for _ in range(30):
            words = list(base)
            for _ in range(rng.randrange(length // 25)):
                words[rng.randrange(length)] = f"edit{rng.randrange(1000)}"
            texts.append(" ".join(words))
    sets = [jaccard.Shingler()(t) for t in texts]
    k = np.arange(len(sets))
    cell = pa.table({
        "key": k, "label": k, "n": [len(s) for s in sets], "asks": [True] * len(k), "tree": [True] * len(k), "both": [True] * len(k),
        "vec": [jaccard.counts(s) for s in sets], "text": texts,
    })
    found, near = jaccard.search_cell(cell), jaccard.touching(cell)
    parent, rough = jaccard.Classes(), jaccard.Classes()
    assert all(parent.join(a, b) and jaccard.links(sets[a], sets[b]) for a, b in found)
    assert all(rough.join(a, b) for a, b in near)
    for a, b in itertools.combinations(range(len(sets)), 2):
        if jaccard.links(sets[a], sets[b]):
            assert parent.find(a) == parent.find(b) and rough.find(a) == rough.find(b)


def test_bound_and_tree_miss_no_link():
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 1 << 63, int(rng.integers(5, 400)), dtype=np.uint64)) for _ in range(12)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.08], rng.integers(0, 1 << 63, 3, dtype=np.uint64)])) for b in base for _ in range(12)]
    points = jaccard.points([jaccard.counts(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = jaccard.CountTree(points, sizes)
    for i, s in enumerate(sets):
        hits = set(tree.search(points[i], int(sizes[i])).tolist())
        assert {j for j, t in enumerate(sets) if jaccard.links(s, t)} <= hits


@pytest.mark.parametrize("text", ["A b\tC d e f", "", None, "über STRASSE x", "a" * 9000 + " b"])
def test_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = jaccard.Shingler()
    h = s.words(text)
    assert len(h) == len(words)
    assert len(set(h.tolist())) == len(set(words))
    assert [int(x) for x in h] == [int(s.words(w)[0]) for w in words]


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (5, 5), (None, 3)]
    got = {r.node: r.label for r in common.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
