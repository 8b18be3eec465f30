"""Substring deduplication by content-defined chunks.

A gear hash of 16 bits rolls over the bytes (each shift drops the oldest one's
share, so it depends on the last 16 bytes only) and proposes cuts at word starts: an
insertion moves the cuts near it and no others. Chunks that several documents have
are found by digest; only windows of them, neighbouring chunks with just enough words
to be a repeated passage, can be copies. A window is one if the same chunks follow
each other at an earlier place, in order of document and place. The text of copied
windows is removed; common phrases stay, however many of them meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: A word start is a cut if these bits of the hash are zero: a chunk has 4 words on average.
MASK = 0x6000
#: Where no word starts, any character may be a cut, if all these bits are zero.
RARE = 0xFC00
MIN_BYTES = 12
#: Longer chunks are cut at rare places, and at twice this length in any case.
MAX_BYTES = 512
#: Words that chunks which follow each other earlier too must have to be removed.
MIN_WORDS = 20
#: In text without spaces, of a word's characters beyond the first LONG_WORD each CHARS count as a word.
LONG_WORD, CHARS = 30, 5

_GEAR = np.frombuffer(hashlib.shake_128(b"gear").digest(512), "<u2")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: sum of GEAR[byte] << age over the last 16 bytes, modulo 2^16."""
    h = _GEAR[data]
    for by in (1, 2, 4, 8):
        h[by:] += h[:-by] << np.uint16(by) if len(h) > by else np.uint16(0)
    return h


def cuts(content: bytes) -> np.ndarray:
    """Where chunks begin, and the end of the last: ascending, from 0 to the length; only 0 if there are no bytes."""
    n = len(content)
    if not n:
        return np.zeros(1, np.int64)
    data = np.frombuffer(content, np.uint8)
    h = gear(data)
    space = _SPACE[data]
    start = space[:-1] & ~space[1:]  # a word begins after this byte
    at = np.flatnonzero(start & (h[:-1] & np.uint16(MASK) == 0)) + 1
    at = _apart(at, MIN_BYTES)
    edges = np.concatenate([[0], at, [n]])
    if len(at) and n - at[-1] < MIN_BYTES:
        edges = np.delete(edges, -2)
    if (np.diff(edges) <= MAX_BYTES).all():
        return edges
    first = (data & 0xC0) != 0x80  # of a UTF-8 character
    rare = np.flatnonzero((h[:-1] & np.uint16(RARE) == 0) & first[1:]) + 1
    out = [0]
    for a, b in zip(edges, edges[1:], strict=False):
        if b - a > MAX_BYTES:
            near = rare[np.searchsorted(rare, a + MAX_BYTES // 4) : np.searchsorted(rare, b - MIN_BYTES)]
            for c in [*_apart(near, MAX_BYTES // 4).tolist(), b]:
                while c - out[-1] > 2 * MAX_BYTES:
                    cut = out[-1] + 2 * MAX_BYTES
                    while not first[cut]:
                        cut -= 1
                    out.append(cut)
                out.append(c)
        else:
            out.append(b)
    return np.array(out)


def _apart(at: np.ndarray, least: int) -> np.ndarray:
    """Without cuts that follow the one kept before too closely."""
    if not len(at) or (at[0] >= least and (np.diff(at) >= least).all()):
        return at
    keep, last = [], 0
    for x in at.tolist():
        if x - last >= least:
            keep.append(x)
            last = x
    return np.array(keep, np.int64)


def chunk_keys(content: bytes, edges: list[int]) -> list[bytes]:
    """Digests of a text's chunks; white space at a chunk's ends doesn't tell chunks apart.

    64 bits suffice: a chance match flags one chunk, and all chunks of a window must match.
    """
    return [hashlib.blake2b(content[a:b].strip(), digest_size=8).digest() for a, b in zip(edges, edges[1:], strict=False)]


def measured(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Fifths (1 / CHARS) of words before each byte and before the end; and whether a byte is inside a word that began before it.

    A word counts where it starts, and its characters beyond the first LONG_WORD count a fifth each: so
    100 such characters without a space are as much as MIN_WORDS words.
    """
    data = np.frombuffer(content, np.uint8)
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = word & ((data & 0xC0) != 0x80)  # of a character
    nth = np.cumsum(first)
    begun = np.maximum.accumulate(np.where(start, nth, 0))  # the number of the word's first character
    units = CHARS * start + (first & (nth - begun >= LONG_WORD))
    return np.concatenate([[0], np.cumsum(units)]), word & ~start


def chunk_words(content: bytes, edges: np.ndarray) -> np.ndarray:
    """For each chunk twice the measure (fifths of words) of what starts in it, plus 1 if it begins inside a word."""
    before, inside = measured(content)
    return 2 * np.diff(before[edges]) + inside[edges[:-1]]


def windows(words: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """First and last chunks of the least windows with min_words words, of chunks that follow each other.

    A word in which the first chunk begins counts too. From each chunk forward and from each chunk back, so that those in a run with min_words words cover it.
    """
    inside, n, least = CHARS * (words & 1), len(words), CHARS * max(1, min_words)
    before = np.concatenate([[0], np.cumsum(words >> 1)])
    i = np.arange(n)
    last = np.maximum(np.searchsorted(before, before[:-1] + least - inside) - 1, i)
    first = np.minimum(np.searchsorted(before[:-1] - inside, before[1:] - least, "right") - 1, i)
    found = {(a, b) for a, b in enumerate(last.tolist()) if b < n}
    found.update((a, b) for b, a in enumerate(first.tolist()) if a >= 0)
    return sorted(found)


def run_windows(places: np.ndarray, words: np.ndarray, min_words: int) -> Iterator[tuple[int, int]]:
    """The windows of each run of neighbours among places (ascending), as positions there; words: of those places."""
    breaks = [0, *(np.flatnonzero(np.diff(places) != 1) + 1).tolist(), len(places)]
    for a, b in zip(breaks, breaks[1:], strict=False):
        if ((words[a:b] >> 1) + CHARS * (words[a:b] & 1)).sum() >= CHARS * min_words:
            yield from ((a + i, a + j) for i, j in windows(words[a:b], min_words))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of a document."""
    schema = pa.schema([("row", pa.int64()), ("tk", pa.int64()), ("ord", pa.int32()), ("words", pa.int32()), ("digest", pa.int64())])

    def flush(rows, ords, words, keys):
        arrays = [*np.concatenate(rows, axis=1), np.concatenate(ords), np.concatenate(words).astype(np.int32), np.frombuffer(b"".join(keys), "<i8")]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], schema=schema)

    for batch, texts in common.text_rows(batches):
        rows, ords, words, keys = [], [], [], []
        for row, tk, text in zip(batch.column("row").to_pylist(), batch.column("tk").to_pylist(), texts, strict=True):
            content = (text or "").encode("utf-8", "surrogatepass")
            if not content:
                continue
            edges = cuts(content)
            n = len(edges) - 1
            rows.append(np.repeat(np.array([[row], [tk]], np.int64), n, axis=1))
            ords.append(np.arange(n, dtype=np.int32))
            words.append(chunk_words(content, edges))
            keys += chunk_keys(content, edges.tolist())
            if len(keys) > 100_000:
                yield flush(rows, ords, words, keys)
                rows, ords, words, keys = [], [], [], []
        if keys:
            yield flush(rows, ords, words, keys)


def _windows(min_words: int):
    """A row for each distinct window of a document's shared chunks, at its first place there."""
    schema = pa.schema([("row", pa.int64()), ("tk", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("high", pa.int64()), ("low", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            keys: list[bytes] = []
            lists = batch.column("places")
            flat, bounds = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            fields = [flat.field(c).to_numpy() for c in ("ord", "words", "digest")]
            for k, name in enumerate(zip(batch.column("row").to_pylist(), batch.column("tk").to_pylist(), strict=True)):
                ords, words, digests = (x[bounds[k] : bounds[k + 1]] for x in fields)
                by = np.argsort(ords)
                ords, words, digests = ords[by], words[by], digests[by]
                first: dict[bytes, tuple[int, int]] = {}
                for i, j in run_windows(ords, words, min_words):
                    key = hashlib.blake2b(digests[i : j + 1].tobytes(), digest_size=16).digest()
                    first.setdefault(key, (int(ords[i]), int(ords[j])))
                out += [(*name, i, j) for i, j in first.values()]
                keys += first
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            columns = [*np.array(out, np.int64).reshape(-1, 4).T, *halves.T]
            arrays = [pa.array(np.ascontiguousarray(c)).cast(f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def all_copies(content: bytes, edges: list[int], given: list[tuple[int, int]] = (), min_words: int = MIN_WORDS) -> list[int]:
    """The chunks of the windows that occur earlier (ascending): of those given, found in documents before, and of those repeated in the text."""
    ids: dict[bytes, int] = {}
    of = [ids.setdefault(content[a:b].strip(), len(ids)) for a, b in zip(edges, edges[1:], strict=False)]
    gone = {k for i, j in given for k in range(i, j + 1)}
    if len(ids) == len(of):
        return sorted(gone)
    chunks = np.array(of)
    again = np.flatnonzero(np.bincount(chunks)[chunks] > 1)
    seen: set[bytes] = set()
    for i, j in sorted(run_windows(again, chunk_words(content, np.array(edges))[again], min_words)):
        key = chunks[again[i] : again[j] + 1].tobytes()
        if key in seen:
            gone.update(range(again[i], again[j] + 1))
        seen.add(key)
    return sorted(int(k) for k in gone)


def removed_spans(content: bytes, edges: list[int], copied: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Byte spans of the runs of copied chunks (ascending) with at least min_words words."""
    spans, i = [], 0
    if not copied:
        return spans
    before, inside = measured(content)
    while i < len(copied):
        j = i
        while j + 1 < len(copied) and copied[j + 1] == copied[j] + 1:
            j += 1
        a, b = edges[copied[i]], edges[copied[j] + 1]
        if before[b] - before[a] + CHARS * inside[a] >= CHARS * min_words:
            spans.append((a, b))
        i = j + 1
    return spans


def _remove(min_words: int, carry: list[str]):
    long = pa.int64()
    fields = [("doc_id", long), ("text", pa.string()), ("n_chunks", long), ("n_copied", long), ("removed_bytes", long), ("spans", pa.list_(pa.list_(long)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_rows(batches):
            out = []
            given = [batch.column(c).to_pylist() for c in ("doc_id", "windows")]
            for doc, found, text in zip(*given, texts, strict=True):
                content = (text or "").encode("utf-8", "surrogatepass")
                edges = cuts(content).tolist()
                found = [(w["start"], w["end"]) for w in found or []]
                spans = removed_spans(content, edges, all_copies(content, edges, found, min_words), min_words)
                n_copied = int(np.diff(np.searchsorted(edges, spans), axis=1).sum()) if spans else 0
                kept, last = [], 0
                for a, b in spans:
                    kept.append(content[last:a])
                    last = b
                kept.append(content[last:])
                new = text if not spans else b"".join(kept).decode("utf-8", "surrogatepass")
                out.append((doc, new, len(edges) - 1, n_copied, sum(b - a for a, b in spans), [list(s) for s in spans]))
            columns = zip(*out, strict=True) if out else [()] * len(fields)
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, *(batch.column(c) for c in carry)], names=[*(name for name, _ in fields), *carry])

    return run


def dedup_substrings(df: DataFrame, min_words: int = MIN_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove repeated passages from the texts of df (doc_id, text).

    Returns doc_id, text (without its removed spans), n_chunks, n_copied (chunks of those
    spans: single chunks that occur elsewhere say nothing), removed_bytes, spans ([start, end) in UTF-8 bytes of the original).
    Documents go by id (null ids last), different texts of one id by a hash of the text. What goes are windows of chunks
    with min_words words (`measured`, so unspaced scripts count by characters) that follow each other in the same way at an earlier place, in
    the same text too; chunks copied from different places add up to nothing. Rows alike in id and text are
    one document twice and get the same result (neither is a copy of the other). Null and empty texts come back
    unchanged; very long ones are cut and compared whole. An empty table gives an empty result; of the other columns those named
    in carry follow.
    """
    spark = df.sparkSession
    common.small_batches(spark)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *common.carried(carry))
    order = F.coalesce("doc_id", F.shiftrightunsigned(F.xxhash64("text"), 2) + (1 << 62))
    docs = docs.withColumns({"row": order, "tk": F.xxhash64("text")})
    key = F.struct("row", "tk")  # an id may have several texts
    chunks = docs.select("row", "tk", "text").mapInArrow(_chunks, "row long, tk long, ord int, words int, digest long")
    repeated = chunks.groupBy("digest").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("rows")).where("first < last")
    repeated = common.materialize(repeated.select("digest", "rows", F.lit(True).alias("shared")), "substring-repeated")
    places = (
        common.hot_join_once(chunks, repeated, "digest")
        .groupBy("row", "tk")
        .agg(F.collect_set(F.struct("ord", "words", "digest")).alias("places"))
    )  # no more than a document has chunks
    places = common.materialize(places, "substring-places")
    found = places.mapInArrow(_windows(min_words), "row long, tk long, start int, end int, high long, low long")
    found = common.materialize(found.select("row", "tk", "start", "end", F.struct("high", "low").alias("window")), "substring-windows")
    earlier = found.groupBy("window").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("rows")).where("first < last")
    earlier = common.materialize(earlier.select("window", "first", "rows"), "substring-earlier")
    copies = (
        common.hot_join(found, earlier, "window", drop="rows")  # a passage of very many documents is one window
        .where(key != F.col("first"))
        .groupBy("row", "tk")
        .agg(F.collect_set(F.struct("start", "end")).alias("windows"))
    )
    extra = docs.schema.fields[2:-2]
    rows = docs.join(copies, ["row", "tk"], "left").select("doc_id", "text", "windows", *(f.name for f in extra))
    schema = T.StructType.fromDDL(
        "doc_id long, text string, n_chunks long, n_copied long, removed_bytes long, spans array<array<long>>"
    )
    out = rows.mapInArrow(_remove(min_words, [f.name for f in extra]), T.StructType([*schema, *extra]))
    return common.uncarried(out, carry)
