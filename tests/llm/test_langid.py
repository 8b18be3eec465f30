import math
import random
import zlib

import numpy as np
from conftest_llm import EXTRA, documents

from tarnlab.llm import langid

SYLLABLES = {"aa": "ka ki ku ko ta to", "bb": "shle brun dorf gard mund", "cc": "ção ñez ió ábel quen", "dd": "xir zzo vvu qax wyx"}


def labelled(spark, n=200):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 4]
        text = " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60)))
        rows.append((i, text, None if i % 11 == 0 else lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_held_out_accuracy(spark):
    df, rows = labelled(spark)
    got = {r.doc_id: r for r in langid.identify(df, langid.fit(df)).collect()}
    out = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i].held_out} == set(out)
    assert np.mean([got[i].lang_pred == sorted(SYLLABLES)[i % 4] for i in out]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_rows_teach_nothing(spark):
    df, _ = labelled(spark)
    other = df.withColumn("lang", langid.F.when(langid.held_out(langid.F.col("doc_id")), "zz").otherwise(langid.F.col("lang")))
    a, b = langid.fit(df), langid.fit(other)
    assert a.languages == b.languages and (a.weights == b.weights).all() and (a.trust == b.trust).all()


def brute(text, model):
    """Scores of a text restated: one n-gram at a time, one language at a time."""
    folds = "".join(c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text.lower())
    data = (" " + folds).encode() + b"   "
    sums, n = [0] * model.words.shape[1], 0
    for i in range(len(data) - 3):
        three = data[i] | data[i + 1] << 8 | data[i + 2] << 16
        four = three | data[i + 3] << 24
        for h in ((three * 2654435761) % 2**32 >> 17, ((four ^ 0x5BD1E995) * 2246822519) % 2**32 >> 17):
            sums = [a + int(b) for a, b in zip(sums, model.weights[h], strict=True)]
            n += 1
    losses = []
    for word in model.words.tolist():
        margin = [s / (langid.SCALE * n) * min(n, 200) ** 0.5 for s in sums]
        losses.append(sum(t * math.log1p(math.exp(-w * m)) for t, w, m in zip(model.trust, word, margin, strict=True)))
    e = [math.exp(-4 * (x - min(losses))) for x in losses]
    return model.languages[losses.index(min(losses))], max(e) / sum(e)


def test_predictions_restated(spark):
    df, rows = labelled(spark, 60)
    model = langid.fit(df)
    for r in langid.identify(df, model).collect():
        lang, score = brute(rows[r.doc_id][1], model)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-9 and r.ambiguous == (r.score < langid.AMBIGUOUS)


def test_fit_counts_every_gram(spark):
    """Whatever a text's length, and however often one n-gram occurs."""
    long = "ka" * 300_000
    df = spark.createDataFrame([(0, long, "aa"), (1, "shle brun dorf " * 50, "bb")], "doc_id long, text string, lang string")
    assert langid._counted(langid.folded(long)).sum() == 2 * (len(langid.folded(long)) - 3)
    assert langid._counted(langid.folded(long)).max() > 65_535
    assert {r.lang_pred for r in langid.identify(df, langid.fit(df)).collect()} == {"aa", "bb"}


def test_no_labels_and_ties(spark):
    df = spark.createDataFrame([(0, "abc def"), (1, None), (None, "abc def")], "doc_id long, text string")
    assert langid.fit(df) is None
    even = df.withColumn("lang", langid.F.lit("x")).union(df.withColumn("lang", langid.F.lit("w")))
    got = langid.identify(df, langid.fit(even)).collect()
    assert {(r.lang_pred, r.ambiguous) for r in got if r.doc_id != 1} == {("w", True)}


def test_edges(docs, spark):
    df, _ = labelled(spark)
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, langid.fit(df), carry=("row",)).collect()]
    assert len(got) == len(documents())
    assert {g[1:] for g in got if g[0] in (12, 13, 14, 33)} == {("und", 0.0)}
    assert len({g[1:] for g in got if g[0] in (2, 10)}) == 1


def test_nothing_to_learn_from(docs, no_docs):
    assert langid.fit(no_docs) is None
    assert langid.identify(no_docs, None).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert "lang" in EXTRA


def test_blocks_give_the_same_sums(monkeypatch):
    rng = np.random.default_rng(1)
    weights = rng.integers(-100, 100, (langid.BUCKETS, 5)).astype(np.int32)
    texts = [langid.folded("".join(chr(97 + x) for x in rng.integers(0, 26, n))) for n in (1, 5, 700, 3, 90)]
    whole = langid._sums(texts, weights)
    monkeypatch.setattr(langid, "BLOCK", 64)
    parts = langid._sums(texts, weights)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_codes():
    for n in (2, 3, 4, 5, 9, 30):
        c = langid.code(n)
        assert c.shape[0] == n and len({tuple(x) for x in c.tolist()}) == n
        assert all(0 < s < n for s in c.sum(0))
    d = langid.code(5)
    assert min((d[i] != d[j]).sum() for i in range(5) for j in range(i)) >= 8
