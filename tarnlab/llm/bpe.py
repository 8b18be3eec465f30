"""Byte-level BPE as a monoid: halves of a piece are encoded recursively and joined.

A token sequence is the BPE encoding of its bytes exactly if every two neighbours
are the encoding of theirs. So a join only has to repair the seam: a window around
it is encoded anew and grows until its first and last token stand with their
outer neighbours; what lies outside has then provably not changed. Decoding joins
the tokens' bytes up a tree.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokens import Memory, Splitter

#: The rank files' pattern of public_tokenizers, with {L}, {N} and {S} for its classes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
REMEMBER = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class TreeBPE:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.merged: dict[bytes, tuple[int, ...]] = {}
        self.stable: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Encode a short window by its merges, lowest rank first and leftmost among equals."""
        if (found := self.merged.get(piece)) is not None:
            return found
        parts = [piece[i : i + 1] for i in range(len(piece))]
        get, none = self.ranks.get, len(self.bytes_of)
        while len(parts) > 1:
            of = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(of)
            if least == none:
                break
            i = of.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out = tuple(self.ranks[p] for p in parts)
        if len(piece) <= 32:
            if len(self.merged) > REMEMBER:
                self.merged.clear()
            self.merged[piece] = out
        return out

    def stands(self, a: int, b: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes."""
        if (found := self.stable.get((a, b))) is None:
            if len(self.stable) > REMEMBER:
                self.stable.clear()
            found = self.stable[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == (a, b)
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.stands(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = b"".join(self.bytes_of[t] for t in left[-i:]) + b"".join(self.bytes_of[t] for t in right[:j])
            new = self.merge(window)
            before = i == len(left) or self.stands(left[-i - 1], new[0])
            after = j == len(right) or self.stands(new[-1], right[j])
            if before and after:
                return left[: len(left) - i] + list(new) + right[j:]
            i, j = i * (1 if before else 2), j * (1 if after else 2)

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one match of the pattern. A piece that is a token is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(piece) <= 4:
            return list(self.merge(piece))
        half = len(piece) // 2
        return self.join(self._half(piece[:half]), self._half(piece[half:]))

    def _half(self, piece: bytes) -> list[int]:
        """As encode, but by merges alone: only a whole match is a token because it is in the table."""
        if len(piece) <= 4:
            return list(self.merge(piece))
        half = len(piece) // 2
        return self.join(self._half(piece[:half]), self._half(piece[half:]))

    def decode(self, ids: array) -> bytes:
        """Bytes of the tokens, joined up a tree of wide nodes."""
        parts = [b"".join(map(self.bytes_of.__getitem__, ids[i : i + 4096])) for i in range(0, len(ids), 4096)]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 16]) for i in range(0, len(parts), 16)]
        return parts[0] if parts else b""


class TextBPE:
    """Encodes whole texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        self.tree = TreeBPE(read_ranks(path))
        self.split = Splitter(PATTERN)
        self.memory = Memory(lambda pieces: [array("I", self.tree.encode(p.encode("utf-8", "replace"))).tobytes() for p in pieces])

    def encode(self, text: str) -> bytes:
        return self.memory(self.split(text))

    def decode(self, ids: bytes) -> bytes:
        a = array("I")
        a.frombytes(ids)
        return self.tree.decode(a)


@functools.lru_cache(maxsize=2)
def text_bpe(path: str) -> TextBPE:
    """One for each worker process, so what a task has learned serves the next one."""
    return TextBPE(path)


def encode_documents(df: DataFrame, path: str) -> DataFrame:
    """Token ids of every row of df (doc_id, text): doc_id, ids (little-endian unsigned 32-bit).

    A null or empty text has no ids. Equal texts have equal ids; repeated rows stay; an
    empty table gives an empty result; other columns are ignored. path: a file of ranks
    that every executor has.
    """
    common.small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = text_bpe(path)
        for batch, texts in common.text_rows(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([bpe.encode(t or "") for t in texts], pa.binary())], names=["doc_id", "ids"]
            )

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode_documents(df: DataFrame, path: str) -> DataFrame:
    """The bytes that the ids of every row stand for: doc_id, ids, decoded."""
    common.small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = text_bpe(path)
        for batch in batches:
            out = [bpe.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())], names=["doc_id", "ids", "decoded"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(df: DataFrame) -> DataFrame:
    """n_tokens and digests of rows with ids and decoded bytes."""
    return df.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
