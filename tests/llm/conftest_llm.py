import random

import pytest
from pyspark.sql import types as T

WORDS = "the of and in that entre mañana über straße thonand wheres ingther edthe nd re".split()

#: Columns that clash with names that operators use inside.
EXTRA = ("lang", "source", "n_chars", "row", "key", "k", "size", "n", "sig", "score", "kept", "ids", "media", "vec", "_doc", "label", "digest", "shard")

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(c, T.StringType()) for c in EXTRA)]
)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "er", "ing", "e", "la"]) for _ in range(n))


def documents() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, copies, near copies, repeated rows and shared passages."""
    rng = random.Random(3)
    base = [sentence(rng, n) for n in (3, 30, 60, 120, 200)]
    passage = sentence(rng, 60)
    near = base[3].split()
    near[60] = "CHANGED"
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(10, base[2]), (11, " ".join(near)), (11, " ".join(near)), (12, None), (13, ""), (14, " \n\t "), (15, "one two"), (16, "ONE\ttwo"), (None, base[2]), (None, None)]
    rows += [(20, sentence(rng, 40) + "\n" + passage + "\n" + sentence(rng, 30)), (21, sentence(rng, 25) + "\n" + passage), (22, base[4] + "\n" + base[4])]
    rows += [(30, "a" * 50_000), (31, sentence(rng, 20_000)), (32, "日本語のテキスト 123 !!! ½²" * 20), (33, "12 34 !!"), (34, "x\x1cy ź İstanbul it's We'LL")]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(i, t, *(f"x{k}" for k in range(len(EXTRA)))) for i, t in documents()], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
