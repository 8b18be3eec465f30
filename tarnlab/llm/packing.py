"""Cost-balanced packing of tokenized documents into sequences of fixed length.

A piece of n tokens costs LINEAR * n + QUADRATIC * n * n (its attention). Documents
go in descending length to the sequence of lowest cost with room for them; where
none has room, the document is cut to fill the emptiest one. Documents are dealt
into groups of bounded size that are packed independently, and each group leaves
less than one sequence unfilled.
"""

from __future__ import annotations

import functools
import heapq
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokens import Memory, Splitter, beyond_latin

LENGTH = 2048
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
END = 1
#: Tokens of one group of documents, about.
GROUP_TOKENS = 64_000_000
#: And its documents, about: their lengths are packed in one task.
GROUP_ROWS = 1 << 20
#: How the word tokenizer cuts lower-cased text, with {L}, {N} and {S} for its classes.
#: Its alternatives begin with different characters, but for the last two, so letters may come first.
WORDS = r"[{L}]+|[{N}]|'(?:s|t|re|ve|m|ll|d)|[^{S}{L}{N}]+"
WORD_END = "</w>"


class WordTokenizer:
    """Ids of whole texts by a word tokenizer's file, little-endian unsigned 32-bit.

    Words are encoded once and remembered. Texts with characters beyond Latin go
    through the tokenizer as they are, with its own normalisation.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # no word is one: texts are parted at them before
        self.special = {t.content: np.array([i], "<u4").tobytes() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.parted = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith(WORD_END)
        self.split = Splitter(WORDS)
        self.memory = Memory(self._many)

    def _ids(self, texts: list[str]) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.array([i for e in found for i in e.ids], "<u4")

    def _many(self, words: list[str]) -> list[bytes]:
        """Words a hundred at a time; the ids that end words part them again."""
        ids = self._ids([" ".join(words[i : i + 100]) for i in range(0, len(words), 100)])
        cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
        if len(cuts) != len(words) + 1:
            return [self._ids([w]).tobytes() for w in words]
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def __call__(self, text: str) -> bytes:
        """Ids as the tokenizer's default call gives them: the string of a special token is that token."""
        if self.parted and any(t in text for t in self.special):
            return b"".join(self.special.get(part) or self._plain(part) for part in self.parted.split(text) if part)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if beyond_latin(text) or "İ" in text:
            return self._ids([unicodedata.normalize("NFC", text)]).tobytes()
        return self.memory(self.split(text.lower()))


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each worker process, so what a task has learned serves the next one."""
    return WordTokenizer(path)


def _tokenize(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(path)
        row = TaskContext.get().partitionId() << 36
        end = np.array([END], "<u4").tobytes()
        for batch, texts in common.text_rows(batches):
            wide = [np.frombuffer(encode(t or "") + end, "<u4") for t in texts]
            # ids under 65536 take two bytes each; the bytes' number tells them from wide ones
            ids = [(x.astype("<u2") if x.max() < 65536 else x).tobytes() for x in wide]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(range(row, row + len(texts)), pa.int64()), pa.array([len(x) for x in wide], pa.int64()), pa.array(ids, pa.binary())],
                schema=schema,
            )
            row += len(texts)

    return run


def tokenize(df: DataFrame, path: str) -> DataFrame:
    """Ids of every row of df (doc_id, text), each closed by END: doc_id, row (unique), n, ids (2 or 4 bytes each)."""
    common.small_batches(df.sparkSession)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.materialize(rows.mapInArrow(_tokenize(path), "doc_id long, row long, n long, ids binary"), "packing-ids")


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def pack(lengths: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pack documents (row, tokens): pieces (row, start, length, sequence, offset), sequences from 0.

    Full stretches of long documents are sequences of their own. What is left is
    placed in descending length, ties by row.
    """
    out, sequence, rest = [], 0, []
    for row, n in sorted(lengths):
        for start in range(0, n - length + 1, length):
            out.append((row, start, length, sequence, 0))
            sequence += 1
        if n % length:
            rest.append((-(n % length), row, n - n % length))
    heapq.heapify(rest)
    k = -(-sum(-x[0] for x in rest) // length)
    room = [length] * k
    spent = [0.0] * k
    fits = [(0.0, s) for s in range(k)]  # by cost; may hold sequences whose room has become too small
    short: list[tuple[int, int]] = []  # by room, largest first: sequences too full for the last document
    while rest:
        negative, row, start = rest[0]
        n = -negative
        while short and -short[0][0] >= n:
            s = heapq.heappop(short)[1]
            heapq.heappush(fits, (spent[s], s))
        while fits and room[fits[0][1]] < n:
            s = heapq.heappop(fits)[1]
            heapq.heappush(short, (-room[s], s))
        if fits:
            s, take = heapq.heappop(fits)[1], n
            heapq.heappop(rest)
        else:
            s = heapq.heappop(short)[1]
            take = room[s]
            # what is left waits for its turn by length, so lengths never rise again
            heapq.heapreplace(rest, (take - n, row, start + take))
        out.append((row, start, take, sequence + s, length - room[s]))
        room[s] -= take
        spent[s] += cost(take)
        if room[s]:
            heapq.heappush(fits, (spent[s], s))
    return out


def _pack_group(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["group"].iat[0])
        pieces = pack(list(zip(pdf["row"].tolist(), pdf["n"].tolist(), strict=True)), length)
        out = pd.DataFrame(pieces, columns=["row", "start", "length", "sequence_id", "offset"], dtype="int64")
        out["sequence_id"] += group << 40
        return out

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    for batch in batches:
        out = []
        for doc, n, ids, pieces in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "pieces")), strict=True):
            a = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
            for p in pieces:
                part = a[p["start"] : p["start"] + p["length"]]
                out.append((doc, p["start"], p["length"], zlib.crc32(part.tobytes()), n, p["sequence_id"], p["offset"]))
        columns = zip(*out, strict=True) if out else [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def pack_documents(df: DataFrame, path: str, length: int = LENGTH, group_tokens: int = GROUP_TOKENS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Tokenize and pack every row of df (doc_id, text).

    Returns a row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. A null or empty text is the END id alone. Each id of each row
    lies in exactly one piece, repeated rows included; sequences are filled from
    offset 0 without gaps. A document longer than `length` is cut. Documents of one length
    go in the order of their rows as read, so which of them meet depends on how the table
    lies in files; the pieces of each document and the padding don't. Very long texts are
    tokenized whole. An empty table gives an empty result; other columns are ignored.
    """
    rows = tokenize(df, path)
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("rows")).first()
    groups = max(1, -(-total.n // group_tokens), -(-total.rows // group_rows))
    sizes = rows.select("row", "n", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"))
    pieces = sizes.groupBy("group").applyInPandas(_pack_group(length), "row long, start long, length long, sequence_id long, offset long")
    by_row = pieces.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    return rows.join(by_row, "row").select("doc_id", "n", "ids", "pieces").mapInArrow(
        _cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
