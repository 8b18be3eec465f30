"""N-gram Jaccard join: exact links of documents by word shingles, found with
count vectors in R-trees.

Shingles are hashed into groups; a document's group counts are a point. The sum over
coordinates of the minimum of two points bounds the overlap: in an R-tree, subtrees
whose upper corner cannot reach the overlap needed are skipped, and pairs that survive
are verified on their shingles.

One tree over all documents would have to compare most documents of similar length
(points of high dimension hardly cluster; README has figures). So documents meet in
trees of those that share a rare shingle: with all shingles in one order, two linked
sets have one in common among the first n - ceil(0.8 n) + 1 of each. The order puts
buckets of shingles that few documents have first, as counted over all documents; the
counts only decide how much is compared, never what is found.

Large groups of near copies are not expanded: first every block's sets search for
the block's first set, and only blocks that still hold two classes are searched
further, row by row, where a link found joins two classes and rows of one class are
not compared again. A cell gives fewer links than it has rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHINGLE = 5
NUM, DEN = 80, 100
GROUPS = 256
LEAF = 16
#: Buckets of shingles whose documents are counted, and how many travel in one row.
BUCKETS = 1 << 16
SLICE = 1 << 12
#: A cell's tree, and the rows that ask it, have at most about so many rows and shingles.
TILE = 4096
TOKENS = 1 << 23
#: Candidates verified at once.
VERIFY = 32
#: Long sets are bounded once more by bits before they are verified: the bytes of a cell's bits, and what counts as long.
FINE_BYTES = 64 << 20
LONG = 1000

#: Bytes as digits: A-Z lower-cased, white space 0.
_FOLD = np.array([0 if b in b" \t\n\v\f\r" else b + 33 if 65 <= b <= 90 else b + 1 for b in range(256)], np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Hashes of the distinct word shingles of a text, ascending.

    A word's hash is its bytes as digits of a number to an odd base, modulo 2^64, and
    mixed: differences of one running sum give all words of a text at once.
    """

    def __init__(self, width: int = SHINGLE):
        self.width = width
        self._powers(1 << 12)

    def _powers(self, n: int) -> None:
        self.power = np.full(n, _P, np.uint64)
        self.inverse = np.full(n, np.uint64(pow(int(_P), -1, 1 << 64)), np.uint64)
        self.power[0] = self.inverse[0] = 1
        np.multiply.accumulate(self.power, out=self.power)
        np.multiply.accumulate(self.inverse, out=self.inverse)

    def words(self, text: str | None) -> np.ndarray:
        """A hash of each word, in order."""
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        if not len(data):
            return np.empty(0, np.uint64)
        if len(data) >= len(self.power):
            self._powers(2 * len(data))
        folded = _FOLD[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = folded != 0
        edge = np.flatnonzero(np.diff(inside))
        start, end = edge[::2], edge[1::2]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(folded * self.power[: len(data)], out=total[1:])
        return _mix((total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def __call__(self, text: str | None) -> np.ndarray:
        w = self.words(text)
        if not len(w):
            return w
        k = min(self.width, len(w))
        h = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            h = h * _P + w[i : len(w) - k + 1 + i]
        return np.unique(_mix(h))


def set_key(tokens: np.ndarray) -> int:
    """64 bits of a strong digest of the set; equal sets have equal keys."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def counts(tokens: np.ndarray) -> bytes:
    """The set as a point: shingles in each of GROUPS groups (the hash's top bits), as far as a byte goes."""
    c = np.bincount((tokens >> np.uint64(64 - GROUPS.bit_length() + 1)).astype(np.int64), minlength=GROUPS)
    return np.minimum(c, 255).astype(np.uint8).tobytes()


def points(vecs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), np.uint8).reshape(len(vecs), GROUPS)


def overlap_bound(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """At most so many shingles are in both sets: summed coordinate minima, and what the bytes could not count."""
    over = np.minimum(na - a.sum(-1, dtype=np.int64), nb - b.sum(-1, dtype=np.int64))
    return np.minimum(a, b).sum(-1, dtype=np.int64) + over


def links(a: np.ndarray, b: np.ndarray, num: int = NUM, den: int = DEN) -> bool:
    if not len(a) or not len(b):
        return False
    common_n = len(np.intersect1d(a, b, assume_unique=True))
    return den * common_n >= num * (len(a) + len(b) - common_n)


class CountTree:
    """R-tree over count vectors, packed by halving along the widest coordinate.

    A node keeps the upper corner of its points, the least set size and the most
    shingles that a point's bytes could not count.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, leaf: int = LEAF):
        self.points, self.sizes, self.leaf = points, sizes, leaf
        self.beyond = sizes - points.sum(1, dtype=np.int64)
        self.order = self._pack(np.arange(len(points)))
        self.levels = []
        upper, least, beyond = points[self.order], sizes[self.order], self.beyond[self.order]
        while len(upper) > leaf or not self.levels and len(upper):
            cuts = np.arange(0, len(upper), leaf)
            upper, least, beyond = np.maximum.reduceat(upper, cuts, axis=0), np.minimum.reduceat(least, cuts), np.maximum.reduceat(beyond, cuts)
            self.levels.append((upper, least, beyond))

    def _pack(self, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= self.leaf:
            return rows
        p = self.points[rows]
        widest = int(np.argmax(p.max(0) - p.min(0)))
        rows = rows[np.argsort(p[:, widest], kind="stable")]
        half = -(-(len(rows) // 2) // self.leaf) * self.leaf
        return np.concatenate([self._pack(rows[:half]), self._pack(rows[half:])])

    def search(self, q: np.ndarray, size: int, num: int = NUM, den: int = DEN) -> np.ndarray:
        """Rows whose bounded overlap may reach the threshold with q."""
        more = size - int(q.sum(dtype=np.int64))

        def may(upper, least, beyond):
            over = np.minimum(upper, q).sum(1, dtype=np.int64) + np.minimum(beyond, more)
            return (den + num) * over >= num * (least + size)

        if not self.levels:
            return np.empty(0, np.int64)
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            at = at[may(*(x[at] for x in self.levels[depth]))]
            width = len(self.levels[depth - 1][0]) if depth else len(self.order)
            at = (at[:, None] * self.leaf + np.arange(self.leaf)).ravel()
            at = at[at < width]
        at = self.order[at]
        s = self.sizes[at]
        at = at[(den * s >= num * size) & (den * size >= num * s)]
        return at[may(self.points[at], self.sizes[at], self.beyond[at])]


class Classes:
    """Union-find over labels."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.parent.get(x, x)
        while up != x:
            above = self.parent.get(up, up)
            self.parent[x] = above
            x, up = up, above
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[b] = a
        return True


class Cell:
    """Rows that meet: those with `tree` are the points of a count-vector tree that those with `asks` search.

    `both` tells of a point that it asks too, here or in another cell.
    """

    def __init__(self, cell: pa.Table, num: int, den: int):
        self.num, self.den = num, den
        self.key, self.label, self.n = (cell.column(c).to_numpy() for c in ("key", "label", "n"))
        self.asks, stored, both = (np.asarray(cell.column(c).to_pylist(), bool) for c in ("asks", "tree", "both"))
        self.vec = points(cell.column("vec").to_pylist())
        self.at = np.flatnonzero(stored)
        self.both, self.point_key, self.point_label = both[self.at], self.key[self.at], self.label[self.at]
        self.tree = CountTree(self.vec[self.at], self.n[self.at])

    def hits(self, q: int) -> np.ndarray:
        """Points of other classes that may link with row q; where both ask, the row with the lesser key does."""
        found = self.tree.search(self.vec[q], int(self.n[q]), self.num, self.den)
        return found[(self.point_label[found] != self.label[q]) & ~(self.both[found] & (self.point_key[found] < self.key[q]))]


def touching(cell: pa.Table, num: int = NUM, den: int = DEN) -> list[tuple[int, int]]:
    """Pairs of labels that join the classes between which the bound leaves a pair: fewer than labels."""
    c, classes, out = Cell(cell, num, den), Classes(), []
    for q in np.flatnonzero(c.asks).tolist():
        mine = int(c.label[q])
        for other in np.unique(c.point_label[c.hits(q)]).tolist():
            if classes.join(mine, other):
                out.append((mine, other))
    return out


def search_cell(cell: pa.Table, num: int = NUM, den: int = DEN, shingle: Shingler | None = None) -> list[tuple[int, int]]:
    """Links of a cell that join classes.

    What may link is verified on the shingles. A link found joins the two classes, and
    rows of one class aren't compared again, so there are fewer links than classes.
    """
    c = Cell(cell, num, den)
    label = c.point_label.tolist()
    shingle = shingle or Shingler()
    texts = cell.column("text")
    held: dict[int, np.ndarray] = {}

    def shingles(row: int) -> np.ndarray:
        found = held.get(row)
        if found is None:
            found = held[row] = shingle(texts[row].as_py())
        return found

    # as many bits a row as the cell's share allows; of use where sets fill few of them
    fine = min(20, int(np.log2(8 * FINE_BYTES / max(1, len(c.key)))))
    bits: dict[int, np.ndarray] = {}

    def flags(row: int) -> np.ndarray:
        found = bits.get(row)
        if found is None:
            has = np.zeros(1 << fine, bool)
            has[(shingles(row) >> np.uint64(64 - fine)).astype(np.int64)] = True
            found = bits[row] = np.packbits(has).view(np.uint64)
        return found

    def likely(q: int, rows: list[int]) -> np.ndarray:
        """Which rows may still link with q: common bits, and what shares a bit in one of the two."""
        a, b = flags(q), np.stack([flags(r) for r in rows])
        n = np.bitwise_count(b).sum(1, dtype=np.int64)
        most = np.bitwise_count(a & b).sum(1, dtype=np.int64) + np.minimum(c.n[q] - int(np.bitwise_count(a).sum(dtype=np.int64)), c.n[rows] - n)
        return (den + num) * most >= num * (c.n[rows] + c.n[q])

    classes, links_found = Classes(), []
    for q in np.flatnonzero(c.asks).tolist():
        own, mine = int(c.key[q]), int(c.label[q])
        sharper = c.n[q] > LONG and 16 * c.n[q] <= 1 << fine
        hits = c.hits(q).tolist()
        while hits:
            top = classes.find(mine)
            hits = [h for h in hits if classes.find(label[h]) != top]
            part, hits = hits[:VERIFY], hits[VERIFY:]
            if not part:
                break
            if sharper:
                keep = likely(q, [int(c.at[h]) for h in part])
                part = [h for h, k in zip(part, keep.tolist(), strict=True) if k]
                if not part:
                    continue
            a, sets = shingles(q), [shingles(int(c.at[h])) for h in part]
            cat = np.concatenate(sets)
            same = a[np.minimum(np.searchsorted(a, cat), len(a) - 1)] == cat
            both = np.add.reduceat(same, np.cumsum([0, *map(len, sets[:-1])]), dtype=np.int64)
            for h, s, o in zip(part, sets, both.tolist(), strict=True):
                if den * o >= num * (len(a) + len(s) - o) and classes.join(mine, label[h]):
                    links_found.append((own, int(c.point_key[h])))
    return links_found


def _over_cells(find, num: int, den: int):
    """What find gives for each cell; rows of a cell follow each other."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in common.runs(batches, ("unit", "tile", "turn")):
            found = find(cell, num, den)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return run


def _facts(width: int):
    """Of each document its set's size and key; of each task how many shingles fall in each bucket."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "tk", "n", "key")] + [("slice", pa.int32()), ("seen", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        seen = np.zeros(BUCKETS, np.int64)
        for batch, texts in common.text_rows(batches):
            sets = [shingle(t) for t in texts]
            if sets:
                seen += np.bincount(bucket(np.concatenate(sets)), minlength=BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tk"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                schema=schema,
            )
        if seen.any():
            parts = seen.reshape(-1, SLICE)
            none = pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none] * 4 + [pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], schema=schema
            )

    return run


def bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts added up by slice."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, seen in zip(b.column("slice").to_pylist(), b.column("seen").to_pylist(), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(seen, np.int64)
    schema = pa.schema([("slice", pa.int32()), ("seen", pa.binary())])
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], schema=schema)


def bucket_levels(seen: DataFrame) -> np.ndarray:
    """How common each bucket of shingles is among all documents, in quarters of a power of two: BUCKETS bytes."""
    total = np.zeros(BUCKETS, np.int64)
    added = seen.mapInArrow(_summed, "slice int, seen binary").repartition(BUCKETS // SLICE, "slice").mapInArrow(_summed, "slice int, seen binary")
    for r in added.collect():  # BUCKETS / SLICE rows
        total[r.slice * SLICE : (r.slice + 1) * SLICE] = np.frombuffer(r.seen, np.int64)
    return (4 * np.log2(1 + total.astype(np.float64))).astype(np.uint8)


def prefix(tokens: np.ndarray, levels: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """The set's rarest shingles, so many that two linked sets have one of them in common.

    Linked sets share at least num / den of the larger one. With all shingles in one
    order, the first that both have is within the first n - ceil(num / den * n) + 1 of
    each. Any order does; rare buckets first keeps the passages that many share out.
    """
    n = len(tokens)
    order = np.argsort(levels[bucket(tokens)], kind="stable")
    return tokens[order[: n - -(-num * n // den) + 1]]


def _set_rows(width: int, levels: np.ndarray, num: int, den: int):
    """Sets as points with their rare shingles; each set once a task."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("vec", pa.binary()), ("prefix", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        seen: set[int] = set()
        for _, texts in common.text_rows(batches):
            out: list[tuple] = []
            for text in texts:
                tokens = shingle(text)
                key = set_key(tokens)
                if len(tokens) and key not in seen:
                    seen.add(key)
                    out.append((key, len(tokens), counts(tokens), prefix(tokens, levels, num, den).view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return run


def _cells(units: DataFrame, sets: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Cells to search: of each unit's rows (unit, key, label, n, asks, tree) every asking one meets every one of the tree.

    A unit with more than TILE rows or TOKENS shingles in its tree is dealt into tiles
    by hash, one with more among those that ask into turns; a cell is a tile and a turn.
    """
    over = lambda c: F.greatest(F.lit(1), F.ceil(F.count_if(c) / TILE), F.ceil(F.sum(F.when(F.col(c), F.col("n"))) / TOKENS)).cast("int")
    sizes = units.groupBy("unit").agg(F.count("*").alias("rows"), over("tree").alias("tiles"), over("asks").alias("turns"))
    dealt = common.hot_join(units, common.materialize(sizes, "jaccard-units"), "unit")
    place = lambda c, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.col(c)).cast("int")
    cell = lambda tile, turn, tree, asks: F.struct(tile.alias("tile"), turn.alias("turn"), tree.alias("tree"), asks.alias("asks"))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    none = F.array().cast("array<struct<tile:int,turn:int,tree:boolean,asks:boolean>>")
    asks_at = lambda turn: F.col("asks") & (turn == F.col("_turn"))
    stored = F.when(F.col("tree"), F.transform(every("turns"), lambda u: cell(F.col("_tile"), u, F.lit(True), asks_at(u)))).otherwise(none)
    asking = F.transform(F.filter(every("tiles"), lambda t: ~F.col("tree") | (t != F.col("_tile"))), lambda t: cell(t, F.col("_turn"), F.lit(False), F.lit(True)))
    asking = F.when(F.col("asks"), asking).otherwise(none)
    rows = dealt.withColumn("_tile", place("tiles", 1)).withColumn("_turn", place("turns", 2)).select("unit", "key", "label", F.col("asks").alias("both"), F.explode(F.concat(stored, asking)).alias("_c"))
    cells = common.materialize(rows.select("unit", "key", "label", "both", "_c.*"), "jaccard-cells")
    rows = cells.join(sets.select("key", "n", *columns), "key")
    return rows.repartition("unit", "tile", "turn").sortWithinPartitions("unit", "tile", "turn")


def _touching(units: DataFrame, sets: DataFrame, num: int, den: int, name: str) -> DataFrame:
    """Pairs of labels (a, b) whose classes are to be compared on their shingles: points alone travel."""
    return common.materialize(_cells(units, sets, ("vec",)).mapInArrow(_over_cells(touching, num, den), "a long, b long").distinct(), f"{name}-touching")


def _links(units: DataFrame, sets: DataFrame, named: DataFrame, docs: DataFrame, width: int, num: int, den: int, name: str) -> DataFrame:
    """Verified links (a, b) that join the classes of each unit. Texts travel, which are shorter than their shingles, and only those of units."""
    wanted = units.select("key").distinct().join(named.select("key", "row.doc_id", "row.tk", "rows"), "key").select("key", _ident(), "tk", "rows")
    wanted = common.materialize(wanted.join(sets.select("key", "n", "vec"), "key"), f"{name}-wanted")
    texts = common.may_be_in(docs.select(_ident(), "tk", "text"), wanted, ["ident", "tk"]).join(wanted, ["ident", "tk"]).drop("ident", "tk")
    texts = common.materialize(texts, f"{name}-texts")
    sets = texts.where("rows = 1").union(texts.where("rows > 1").dropDuplicates(["key"]))  # rows alike in id and text
    found = _cells(units, sets, ("vec", "text")).mapInArrow(_over_cells(functools.partial(search_cell, shingle=Shingler(width)), num, den), "a long, b long")
    return common.materialize(found, f"{name}-links")


def _ident():
    """An id that joins, null or not."""
    return F.coalesce("doc_id", F.lit(-(1 << 63))).alias("ident")


def _but_largest(held: DataFrame, name: str) -> DataFrame:
    """Units of rows (unit, key, n, label): those of the largest class needn't ask, as all others do."""
    by_label = held.groupBy("unit", "label").agg(F.count("*").alias("c"))
    largest = by_label.groupBy("unit").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("rows"))
    rows = common.hot_join(held, common.materialize(largest, f"{name}-largest"), "unit")
    return common.materialize(rows.select("unit", "key", "label", "n", (F.col("label") != F.col("top.label")).alias("asks"), F.lit(True).alias("tree")), f"{name}-units")


def _classes(df: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """doc_id, tk (text hash), n, component_id, first (the row, or one just like it, that stands for its class)."""
    spark = df.sparkSession
    common.small_batches(spark)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("tk", F.xxhash64("text"))
    found = common.materialize(
        docs.mapInArrow(_facts(width), "doc_id long, tk long, n long, key long, slice int, seen binary"), "jaccard-facts"
    )
    facts = found.where("slice is null").select("doc_id", "tk", "n", "key")
    levels = bucket_levels(found.where("slice is not null").select("slice", "seen"))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tk")
    named = common.materialize(
        facts.where("key is not null").groupBy("key").agg(F.min(row).alias("row"), F.count("*").alias("rows")), "jaccard-named"
    )
    sets = docs.select("text").mapInArrow(_set_rows(width, levels, num, den), "key long, n long, vec binary, prefix array<long>")
    sets = common.materialize(sets.dropDuplicates(["key"]), "jaccard-sets")

    # sets that share a rare shingle: each with the first of them
    rare = sets.select(F.explode("prefix").alias("sig"), "key")
    blocks = rare.groupBy("sig").agg(F.min("key").alias("lead"), F.count("*").alias("rows")).where("rows > 1")
    blocks = common.materialize(blocks, "jaccard-blocks")
    members = common.materialize(common.hot_join(rare, blocks, "sig").select("sig", "key", "lead", "rows"), "jaccard-members")
    size = sets.select("key", "n")
    pairs = members.where("key <> lead").select(F.col("lead").alias("unit"), "key").distinct().join(size, "key").join(size.select(F.col("key").alias("unit"), F.col("n").alias("ln")), "unit")
    pairs = common.materialize(pairs.where((den * F.col("n") >= num * F.col("ln")) & (den * F.col("ln") >= num * F.col("n"))), "jaccard-pairs")
    side = lambda k, n, asks: pairs.select("unit", F.col(k).alias("key"), F.col(k).alias("label"), F.col(n).alias("n"), F.lit(asks).alias("asks"), F.lit(not asks).alias("tree"))
    stars = common.materialize(side("key", "n", False).union(side("unit", "ln", True).distinct()), "jaccard-star-units")
    near = _touching(stars, sets, num, den, "jaccard-star")  # a leads, b is another set of its block
    stars = stars.where("tree").join(near.select(F.col("a").alias("unit"), F.col("b").alias("key")), ["unit", "key"], "left_semi").union(
        stars.where("asks").join(near.select(F.col("a").alias("unit")), "unit", "left_semi")
    )
    star_links = _links(common.materialize(stars, "jaccard-star-near"), sets, named, docs, width, num, den, "jaccard-star")
    labels = common.connected_components(star_links, "jaccard-star-components")

    # blocks that still hold two classes; those of the same classes are searched as one
    label = F.coalesce("label", "key").alias("label")
    labelled = members.where("rows > 2").join(labels.withColumnRenamed("node", "key"), "key", "left").select("sig", "key", label)
    mixed = common.materialize(
        labelled.groupBy("sig", "label").agg(F.count("*").alias("rows"))
        .groupBy("sig").agg(F.count("*").alias("classes"), F.sum(F.xxhash64("label").cast("decimal(20,0)")).alias("content"), F.sum("rows").alias("rows"))
        .where("classes > 1").select("sig", "rows", F.xxhash64("classes", "content").alias("unit")),
        "jaccard-mixed",
    )
    if not mixed.isEmpty():
        held = common.materialize(common.hot_join(labelled, mixed, "sig").select("unit", "key", "label").distinct().join(size, "key"), "jaccard-held")
        near = _touching(_but_largest(held, "jaccard-held"), sets, num, den, "jaccard-rest")
        # classes that touch, however many blocks they meet in, are one unit, which has each set once
        unit = common.connected_components(near, "jaccard-units-of-classes").select(F.col("node").alias("label"), F.col("label").alias("unit"))
        each = sets.select("key", "n").join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", "n", label)
        sized = each.groupBy("label").agg(F.count("*").alias("rows")).join(unit, "label")
        near = common.hot_join(each, common.materialize(sized, "jaccard-touching-classes"), "label").select("unit", "key", "n", "label")
        rest = _links(_but_largest(common.materialize(near, "jaccard-near"), "jaccard-near"), sets, named, docs, width, num, den, "jaccard-rest")
        if not rest.isEmpty():
            labels = common.connected_components(star_links.union(rest), "jaccard-components")
    classes = named.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = classes.groupBy("label").agg(F.min("row").alias("least"), F.count("*").alias("rows"))
    classes = common.hot_join(classes.drop("row"), common.materialize(least, "jaccard-least"), "label", drop="rows").select("key", "rows", "least")
    classes = common.materialize(classes, "jaccard-classes")
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("tk") == F.col("least.tk"))
    with_words = common.hot_join(facts.where("key is not null"), classes, "key").select("doc_id", "tk", "n", F.col("least.doc_id").alias("component_id"), first.alias("first"))
    wordless = facts.where("key is null").select("doc_id", "tk", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return with_words.union(wordless)


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, num: int = NUM, den: int = DEN
) -> DataFrame:
    """Classes of documents linked by den * overlap >= num * union of their shingle sets.

    Returns one row per input row: doc_id, n_shingles, component_id (the least
    doc_id reachable by links). Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased;
    a text of fewer than `width` words is one shingle. Null and wordless texts have
    no shingles, link with nothing and are their own component. Repeated rows are
    equal sets and stay separate rows; rows of one id with different texts are
    documents of their own. A null id is never the least unless all are null. Very
    long texts are shingled whole, in memory of some ten times the text. A tie at the
    threshold is a link. An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    return _classes(df, id_col, text_col, width, num, den).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, num: int = NUM, den: int = DEN
) -> DataFrame:
    """The rows of df that stay if one document of each class stays: that with the least id.

    Rows without an id stay only where their class has none with one. Of several
    texts of the least id in one class that with the least hash stays; of rows alike
    in id and text that whose columns come first as JSON. Rows without words link with
    nothing and all stay. All columns return as they are.
    """
    found = _classes(df, id_col, text_col, width, num, den).where("first")
    kept = found.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_i"), F.col("tk").alias("_t"), (F.col("n") > 0).alias("_w"))
    kept = kept.groupBy("_i", "_t").agg((F.bool_or("_w") & (F.count("*") > 1)).alias("_several"))
    kept = common.materialize(kept, "jaccard-kept")
    whole = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_i"),
        F.xxhash64(F.col(text_col).cast("string")).alias("_t"),
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"),
    )
    several = common.materialize(kept.where("_several").select("_i", "_t"), "jaccard-several")
    rows = whole.join(kept.where("not _several").select("_i", "_t"), ["_i", "_t"], "left_semi").select("_row.*")
    if several.isEmpty():
        return rows
    repeated = common.may_be_in(whole, several, ["_i", "_t"]).join(several, ["_i", "_t"], "left_semi")
    return rows.union(repeated.groupBy("_i", "_t").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*"))
