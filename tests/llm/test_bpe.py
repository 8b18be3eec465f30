import base64
import hashlib
import random
from array import array
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from conftest_llm import documents

from tarnlab.llm import bpe, queries


@pytest.fixture(scope="module")
def library():
    with open(queries.BYTE_BPE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.TextBPE(queries.BYTE_BPE)


def ids(own, text):
    a = array("I")
    a.frombytes(own.encode(text))
    return a.tolist()


def test_random_texts(own, library):
    rng = random.Random(1)
    pools = ["abcdefgh the", "aA zZ'sll'd  \n\t", "é ß ö日本語 ½²٣", "   x\x1c\x85.", "aaaa", "the and ing er on", "!!??--  x", "0123 45", "😀é́a b"]
    for _ in range(5000):
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(60)))
        assert ids(own, text) == library.encode_ordinary(text), repr(text)
        assert own.decode(own.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 4000 + "x", "thereation" * 2000, "é" * 3000])
def test_long_matches(own, library, text):
    assert ids(own, text) == library.encode_ordinary(text)


def test_the_tree_alone(own, library):
    """Without the table's shortcut and the memory: joins of halves of any length."""
    rng = random.Random(2)
    for _ in range(3000):
        piece = "".join(rng.choice("thereing and") for _ in range(rng.randrange(1, 40))).replace(" ", "").encode() or b"a"
        tree = own.tree._half(piece)
        assert tree == list(own.tree.merge(piece))


def test_documents(docs, library):
    got = bpe.digests(bpe.decode_documents(bpe.encode_documents(docs, queries.BYTE_BPE), queries.BYTE_BPE)).collect()
    expected = Counter()
    for i, t in documents():
        a = array("I", library.encode_ordinary(t or ""))
        expected[i, len(a), hashlib.sha256(a.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == expected


def test_empty(no_docs):
    assert bpe.encode_documents(no_docs, queries.BYTE_BPE).count() == 0
