"""Language identification by error-correcting output codes.

Every language has a codeword; for each of its bits a binary n-gram classifier
tells languages with a 1 from those with a 0. Decoding weighs each bit's logistic
loss by how reliable the bit's classifier was on documents it was not fitted on,
chooses the language of least loss and flags documents whose two best are close.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

UNKNOWN = "und"
#: Labelled documents that the classifiers are fitted on, about and for each language (those of least hash).
DOCS_PER_LANGUAGE = 400
BUCKETS = 1 << 15
#: Weights are integers of this scale, so sums are exact in any order.
SCALE = 256
CLIP = 8 * SCALE
#: Bits of a codeword, at least; with few languages all different splits are used.
MIN_BITS = 15
#: Below this score a document counts as ambiguous.
AMBIGUOUS = 0.55
#: Bytes scored at once.
BLOCK = 1 << 18

_LETTER = regex.compile(r"\p{L}")
#: ASCII upper case is lowered, other ASCII but letters is a space; what isn't ASCII stays.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _hashes(data: np.ndarray) -> np.ndarray:
    """Buckets of the byte 3-grams and 4-grams that begin at each place but the last three: shape (2, n)."""
    d = data.astype(np.uint32)
    three = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16)
    four = three | d[3:] << np.uint32(24)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    a = (three * np.uint32(2654435761)) >> shift
    b = ((four ^ np.uint32(0x5BD1E995)) * np.uint32(2246822519)) >> shift
    return np.stack([a, b])


def folded(text: str) -> bytes:
    """The text's bytes for n-grams: lower case, framed by spaces."""
    return b" " + text.lower().encode("utf-8", "surrogatepass").translate(_FOLD) + b"   "


def code(languages: int) -> np.ndarray:
    """Codewords (languages, bits), chosen for distance; no column or its complement repeats."""
    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= 5:  # exhaustive
        columns = [[(c >> i) & 1 for i in range(languages)] for c in range(1, 1 << (languages - 1))]
        return np.array(columns, np.int8).T
    bits = max(MIN_BITS, int(np.ceil(6 * np.log2(languages))))
    rng = np.random.default_rng(7)
    best, found = -1, None
    for _ in range(200):
        m = rng.integers(0, 2, (languages, bits)).astype(np.int8)
        split = m.sum(0)
        if (split == 0).any() or (split == languages).any():
            continue
        apart = min(int((m[i] != m[j]).sum()) for i in range(languages) for j in range(i))
        if apart > best:
            best, found = apart, m
    return found


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray  # codewords as -1 and 1
    weights: np.ndarray  # (buckets, bits), integers
    trust: np.ndarray  # of each bit, sums to 1

    def losses(self, sums: np.ndarray, grams: int) -> np.ndarray:
        """Loss of each language for a document's summed bit scores."""
        margin = sums / (SCALE * max(grams, 1)) * min(grams, 200) ** 0.5
        return (np.logaddexp(0, -self.words * margin) * self.trust).sum(1)

    def decode(self, sums: np.ndarray, grams: int) -> tuple[str, float, bool]:
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = self.losses(sums, grams)
        p = np.exp(-(loss - loss.min()) * 4)
        best = int(np.argmin(loss))
        score = float(p[best] / p.sum())
        return self.languages[best], score, score < AMBIGUOUS


def _sums(texts: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed weights of each text, and its number of n-grams."""
    out = np.zeros((len(texts), weights.shape[1]), np.int64)
    n = np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        if len(texts[i]) > BLOCK:  # a long text by itself, in blocks that overlap by an n-gram
            for at in range(0, len(texts[i]) - 3, BLOCK):
                h = _hashes(np.frombuffer(texts[i][at : at + BLOCK + 3], np.uint8))
                out[i] += weights[h].sum((0, 1), dtype=np.int64)
                n[i] += h.size
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and len(texts[j]) <= BLOCK and size + len(texts[j]) <= BLOCK:
            size += len(texts[j])
            j += 1
        lengths = np.array([len(t) for t in texts[i:j]])
        starts = np.cumsum(lengths) - lengths
        h = _hashes(np.frombuffer(b"".join(texts[i:j]), np.uint8))
        w = weights[h[0]]
        w += weights[h[1]]
        for end in starts[1:]:  # n-grams that reach over two texts
            w[end - 3 : end] = 0
        out[i:j] = np.add.reduceat(w, starts, axis=0)
        n[i:j] = 2 * (lengths - 3)
        i = j
    return out, n


def _counted(data: bytes) -> np.ndarray:
    """How often each bucket's n-grams occur in a folded text, block by block."""
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(data) - 3, 1), BLOCK):
        out += np.bincount(_hashes(np.frombuffer(data[at : at + BLOCK + 3], np.uint8)).ravel(), minlength=BUCKETS)
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of each task's documents by language, and by whether they try the bits or fit them."""
    total: dict[tuple[str, bool], np.ndarray] = {}
    for batch, texts in common.text_rows(batches):
        for lang, tries, t in zip(batch.column("lang").to_pylist(), batch.column("tries").to_pylist(), texts, strict=True):
            total[lang, tries] = total.get((lang, tries), 0) + _counted(folded(t))
    yield from _count_rows(total)


def _count_rows(total: dict[tuple[str, bool], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (lang, tries), n in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([tries]), pa.array([n.tobytes()], pa.binary())], names=["lang", "tries", "n"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[str, bool], np.ndarray] = {}
    for batch in batches:
        for lang, tries, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "tries", "n")), strict=True):
            total[lang, tries] = total.get((lang, tries), 0) + np.frombuffer(n, np.int64)
    yield from _count_rows(total)


def _tried(languages: list[str], words: np.ndarray, weights: np.ndarray):
    """Of each task's documents, how many each bit's classifier gets wrong, and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrong, seen = np.zeros(words.shape[1], np.int64), 0
        for batch, texts in common.text_rows(batches):
            if texts:
                sums, _ = _sums([folded(t) for t in texts], weights)
                is_one = words[[languages.index(x) for x in batch.column("lang").to_pylist()]] == 1
                wrong += ((sums > 0) != is_one).sum(0)
                seen += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array([wrong.tolist()], pa.list_(pa.int64())), pa.array([seen], pa.int64())], names=["wrong", "seen"])

    return run


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 when divided by 4. A null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model | None:
    """Fit on about per_language documents of each language that aren't held out; None without any.

    Which ones depends on a hash of the id; a quarter of them, by another hash, only try the
    bits. Counts are summed in the executors: what comes to the driver are two rows of
    BUCKETS numbers for each language, whatever the texts' number and length.
    """
    if "lang" not in docs.columns:
        return None
    common.small_batches(docs.sparkSession)
    open_docs = docs.where("lang is not null and text is not null").where(~held_out(F.col("doc_id")))
    n = {r.lang: r.n for r in open_docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not n:
        return None
    share = json.dumps({lang: min(1.0, per_language / k) for lang, k in n.items()})
    fraction = F.try_element_at(F.from_json(F.lit(share), "map<string,double>"), F.col("lang"))
    drawn = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) < fraction * (1 << 30)
    tries = F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(4)) == 0
    rows = open_docs.where(drawn).select("lang", tries.alias("tries"), F.col("text").cast("string").alias("text"))
    kind = "lang string, tries boolean, n binary"
    found = rows.mapInArrow(_counts, kind).repartition("lang", "tries").mapInArrow(_added, kind).collect()
    counts = {(r.lang, r.tries): np.frombuffer(r.n, np.int64) for r in found}
    languages = sorted({lang for lang, _ in counts})
    if not languages:
        return None
    words = code(len(languages))

    def weights(folds: tuple[bool, ...]) -> np.ndarray:
        each = np.full((len(languages), BUCKETS), 0.5)
        for i, lang in enumerate(languages):
            for fold in folds:
                each[i] += counts.get((lang, fold), 0)
        each /= each.sum(1, keepdims=True)
        out = np.zeros((BUCKETS, words.shape[1]))
        for b in range(words.shape[1]):
            one, zero = each[words[:, b] == 1].mean(0), each[words[:, b] == 0].mean(0)
            out[:, b] = np.log(one / zero)
        return np.clip(np.rint(out * SCALE), -CLIP, CLIP).astype(np.int32)

    if not words.shape[1]:
        return Model(languages, words * 2 - 1, weights((True, False)), np.zeros(0))
    # reliability of each bit: its error on the documents that try it, fitted on the others
    tried = rows.where("tries").mapInArrow(_tried(languages, words, weights((False,))), "wrong array<bigint>, seen bigint")
    total = tried.select(F.posexplode("wrong").alias("bit", "wrong"), "seen").groupBy("bit").agg(F.sum("wrong").alias("wrong"), F.sum("seen").alias("seen")).collect()
    error = np.full(words.shape[1], 0.5)
    for r in total:
        error[r.bit] = (1 + r.wrong) / (2 + r.seen)
    error = np.clip(error, 1e-3, 0.49)
    trust = np.log((1 - error) / error)
    return Model(languages, words * 2 - 1, weights((True, False)), trust / trust.sum())


def _predict(model: Model | None, carry: list[str]):
    names = ["doc_id", "held_out", "lang_pred", "score", "ambiguous"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_rows(batches):
            out = [(UNKNOWN, 0.0, True)] * len(texts)
            at = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if model else []
            if at:
                sums, n = _sums([folded(texts[i]) for i in at], model.weights)
                for i, s, k in zip(at, sums, n, strict=True):
                    out[i] = model.decode(s, int(k))
            lang, score, unsure = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_()), *(batch.column(c) for c in carry)],
                names=[*names, *carry],
            )

    return run


def identify(docs: DataFrame, model: Model | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Language of the whole text of every row of docs (doc_id, text).

    Returns doc_id, held_out, lang_pred, score (0 to 1), ambiguous. A null text, one
    without a letter, or any text if nothing could be learned, is `und` with score 0.
    Equal texts get equal results; repeated rows stay; very long texts are scored whole,
    in blocks. Languages of equal loss are a tie: the first by name is chosen and flagged.
    An empty table gives an empty result, and a table without labels learns nothing. Of
    the other columns those named in carry follow.
    """
    common.small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
        *common.carried(carry),
    )
    schema = T.StructType.fromDDL("doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
    extra = rows.schema.fields[3:]
    out = rows.mapInArrow(_predict(model, [f.name for f in extra]), T.StructType([*schema, *extra]))
    return common.uncarried(out, carry)
