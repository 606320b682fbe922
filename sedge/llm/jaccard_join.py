"""Exact n-gram Jaccard join with signature trees.

A document's set is its distinct word shingles, as 64-bit hashes.  Two documents link at an intersection
of at least ``num / den`` of the union.  The join loses no link and caps nothing:

1. Documents with equal sets are one class, whose smallest id stands for it.
2. A document can only link if its prefix (its smallest hashes, a third or so) shares enough hashes
   with those of others.  Prefix hashes meet in hash buckets as packed arrays; a task sends each hash
   once however many of its documents have it, so a frequent hash costs a bucket one entry a task.  The
   number of buckets follows the number of hashes, a task works on one bucket at a time, and what it
   finds goes on packed as well, a row for each part of the documents.
3. Candidates that share a key are put in one block: components of stars that the buckets return.  A key
   is a run of ``RUN`` neighbours in a sorted set, with a range of set sizes: one set's elements that the
   other lacks break few runs, so linked sets share some, while texts with a passage in common hardly do.
   Every link lies within a block.
4. In a block, documents are ordered by smallest hash and become the leaves of a signature tree: a node
   holds the OR of its documents' bitmaps and the range of their set sizes.  A dual traversal prunes
   node pairs whose sizes or whose largest possible overlap rule a link out, and those whose documents
   are all connected already; what is left is verified on the whole sets.
5. A block of more than ``most`` hashes or documents is dealt into chunks, twice, by different hashes;
   if that has not connected it, all pairs of its chunks whose sizes can link are traversed.

Defined cases: a null or blank text has the empty set and links with nothing; a text of fewer words than
a shingle is one shingle; a null id gets the smallest id of its class, or null; rows that share an id but
not a text count as linked; repeated rows give repeated results; other columns are left out, so their
names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import MOST_PARTITIONS, lean, new_folder, removed, text_batches, written

LEAF = 4
RUN = 3
SHARED = 25  # per cent of a set
MIX_A, MIX_B, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers whose bits all depend on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX_A
        x = (x ^ (x >> np.uint64(27))) * MIX_B
        return x ^ (x >> np.uint64(31))


class Shingles(dict):
    """Texts to sorted arrays of distinct shingle hashes; holds a bounded number of word hashes."""

    def __init__(self, width: int = 5, most: int = 150_000):
        super().__init__()
        self.width, self.most = width, most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = h
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []
        n, w = len(words), self.width
        if not n:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.__getitem__, words), np.uint64, n)
        with np.errstate(over="ignore"):
            got = np.full(max(1, n - w + 1), min(n, w), np.uint64)
            for k in range(min(n, w)):
                got *= STEP
                got += h[k : k + len(got)]
        got = mixed(got)
        got.sort()
        return got[np.concatenate([[True], got[1:] != got[:-1]])]


class Bounds:
    """What a link at ``num / den`` asks of set sizes, in integers."""

    def __init__(self, num: int = 75, den: int = 100):
        self.num, self.den = num, den

    def least(self, n: int) -> int:
        """The smallest intersection of a set of n with any that it links to."""
        return -(-n * self.num // self.den)

    def shared(self, n: int) -> int:
        return max(1, n * SHARED // 100)

    def prefix(self, n: int) -> int:
        return n - self.least(n) + 1

    def wide(self, n: int) -> int:
        """So many smallest hashes that linked documents share ``shared`` of the smaller set's."""
        return min(n, n - self.least(n) + self.shared(n))

    def needed(self, n: int) -> int:
        return min(self.shared(self.least(n)), self.wide(n))

    def runs(self, n: int) -> int:
        """So many runs, at least, a set of n shares with any that it links to: of i shared elements in
        order i - RUN + 1 runs can be formed, and each of the u - i others breaks at most RUN - 1."""
        return -(-n * (self.den - RUN * (self.den - self.num)) // self.den) - RUN + 1

    @cached_property
    def long(self) -> int | None:
        """Sets from this size on always share a run; None if no size has that."""
        return next((n for n in range(RUN, 10_000) if self.runs(n) > 0), None) if self.den > RUN * (self.den - self.num) else None

    @cached_property
    def sizes(self) -> np.ndarray:
        """Lower bounds of size ranges; linked sets lie in the same or in neighbouring ones."""
        found = [1]
        while found[-1] < 1 << 40:
            found.append(max(found[-1] * self.den // self.num, found[-1] * 9 // 8) + 1)
        return np.array(found, np.int64)

    def keys(self, s: np.ndarray) -> np.ndarray:
        """Keys of a sorted set; linked sets share one at least.

        Short sets have their prefix; those near the limit have both kinds.
        """
        n, found = len(s), []
        size = int(np.searchsorted(self.sizes, n, "right"))
        with np.errstate(over="ignore"):
            if self.long is None or n * self.num < self.long * self.den:
                found.append(s[: self.prefix(n)])
            if self.long is not None and n >= self.long:
                runs = s[: n - RUN + 1]
                for k in range(1, RUN):
                    runs = mixed(runs * STEP + s[k : n - RUN + 1 + k])
                most = n - RUN + 1 - self.runs(n) + 1
                found.append(np.partition(runs, most - 1)[:most] if most < len(runs) else runs)
            return np.concatenate([mixed(f + np.uint64(size + k) * STEP) for f in found for k in (0, 1)])

    def overlap(self, a, b):
        """The smallest intersection of linked sets of sizes a and b."""
        return -(-(a + b) * self.num // (self.num + self.den))


# --- hash buckets ---------------------------------------------------------------------------------

DEALT = "bucket int, first long, hashes binary, docs binary, known binary, pairs binary"


def _ordered(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, start of each group of equal hashes, group sizes, group of each row)."""
    order = np.lexsort((docs, hashes))
    h = hashes[order]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    size = np.diff(np.append(start, len(h)))
    return order, h, start, size, np.repeat(np.arange(len(start)), size)


def _pairs(a: np.ndarray, b: np.ndarray, count: bool) -> np.ndarray:
    """Credits: (doc, how often); links: distinct (doc, smallest doc)."""
    if count:
        docs, n = np.unique(a, return_counts=True)
        return np.stack([docs, n.astype(np.int64)], 1)
    keep = a != b
    a, b = a[keep], b[keep]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return np.stack([a[new], b[new]], 1)


def _deal(prefixes: Iterator[tuple[int, np.ndarray]], buckets: int, credit: bool, most: int = 300_000) -> Iterator:
    """A task's prefix hashes as one packed row for each bucket; what it knows itself goes along.

    A hash that several of its documents have is sent once: as known to be shared (credit), or with its
    smallest document (links).
    """
    import pyarrow as pa

    docs, sets, size = [], [], 0

    def packed():
        hashes, owners = np.concatenate(sets), np.repeat(np.array(docs, np.int64), [len(s) for s in sets])
        order, h, start, counts, group = _ordered(hashes, owners)
        d = owners[order]
        many = counts[group] > 1
        pairs = _pairs(d[many], d[start][group][many], credit)
        h, d, known = h[start], d[start], (counts > 1) & credit
        m = mixed(h)
        at, short = (m % np.uint64(buckets)).astype(np.int64), (m >> np.uint64(32)).astype("<u4")
        first = int(d.min())
        kind = "<u4" if int(d.max()) - first < 1 << 32 else "<i8"
        by = np.argsort(at, kind="stable")
        filled, edges = np.unique(at[by], return_index=True)
        edges = np.append(edges, len(by))
        rows = []
        for i, k in enumerate(filled.tolist()):
            part = by[edges[i] : edges[i + 1]]
            rows.append((k, first, short[part].tobytes(), (d[part] - first).astype(kind).tobytes(), np.packbits(known[part]).tobytes(), pairs[i :: len(filled)].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), pa.int64()] + [pa.binary()] * 4, strict=True)], names=[f.split(" ")[0] for f in DEALT.split(", ")])

    for doc, found in prefixes:
        docs.append(doc)
        sets.append(found)
        size += len(found)
        if size >= most:
            yield packed()
            docs, sets, size = [], [], 0
    if size:
        yield packed()


def _grouped(batches: Iterator) -> Iterator:
    """(group, rows) of rows that follow one another with the same first column."""
    now, held = None, []
    for batch in text_batches(batches, 256):
        names = batch.schema.names
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != now and held:
                yield now, held
                held = []
            now = row[0]
            held.append(dict(zip(names, row, strict=True)))
    if held:
        yield now, held


def _dealt(rows: DataFrame, by: str, parts: int) -> DataFrame:
    """A partition for each value of ``by`` below ``parts``, or for neighbouring ones; sorted by it."""
    n = min(parts, MOST_PARTITIONS)
    return rows.repartitionById(n, F.floor(F.col(by).cast("long") * n / parts).cast("int")).sortWithinPartitions(by)


PACKED = "part int, a binary, b binary"


def _summed(told: np.ndarray, credit: bool) -> np.ndarray:
    """Credits added up by document, or distinct links."""
    if not credit:
        return _pairs(told[:, 0], told[:, 1], False)
    docs, at = np.unique(told[:, 0], return_inverse=True)
    return np.stack([docs, np.bincount(at, told[:, 1], len(docs)).astype(np.int64)], 1)


def _meet(dealt: DataFrame, credit: bool, buckets: int) -> DataFrame:
    """Buckets to credits (a: doc, b: shared hashes) or links (a: doc, b: smallest doc), each a once or each pair once.

    Within a bucket 32 bits stand for a hash: two that fall together only add to what is looked at later.
    """
    parts = -(-buckets // 4)

    def packed(told: np.ndarray) -> Iterator:
        import pyarrow as pa

        part = (mixed(told[:, 0].view(np.uint64)) >> np.uint64(20)) % np.uint64(parts)
        by = np.argsort(part, kind="stable")
        filled, edges = np.unique(part[by], return_index=True)
        edges = np.append(edges, len(by))
        rows = [(int(k), told[by[edges[i] : edges[i + 1]], 0].tobytes(), told[by[edges[i] : edges[i + 1]], 1].tobytes()) for i, k in enumerate(filled)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), pa.binary(), pa.binary()], strict=True)], names=["part", "a", "b"])

    def run(batches: Iterator, most: int = 500_000) -> Iterator:
        told, size = [], 0
        for _, rows in _grouped(batches):
            hashes = [np.frombuffer(r["hashes"], "<u4") for r in rows]
            docs = [np.frombuffer(r["docs"], "<u4" if len(r["docs"]) == 4 * len(h) else "<i8").astype(np.int64) + r["first"] for r, h in zip(rows, hashes, strict=True)]
            known = np.concatenate([np.unpackbits(np.frombuffer(r["known"], np.uint8), count=len(h)).astype(bool) for r, h in zip(rows, hashes, strict=True)])
            own = np.concatenate([np.frombuffer(r["pairs"], np.int64).reshape(-1, 2) for r in rows])
            order, _, start, counts, group = _ordered(np.concatenate(hashes), np.concatenate(docs))
            d, known = np.concatenate(docs)[order], known[order]
            if credit:
                take = ((counts > 1) | np.logical_or.reduceat(known, start))[group] & ~known
            else:
                take = counts[group] > 1
            told += [own, _pairs(d[take], d[start][group][take], credit)]
            size += len(told[-1]) + len(own)
            if size >= most:
                yield from packed(_summed(np.concatenate(told), credit))
                told, size = [], 0
        if told:
            yield from packed(_summed(np.concatenate(told), credit))

    def gather(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for _, rows in _grouped(batches):
            told = np.stack([np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in "ab"], 1)
            told = _summed(told, credit)
            for at in range(0, len(told), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(told[at : at + 100_000, 0]), pa.array(told[at : at + 100_000, 1])], names=["a", "b"])

    found = _dealt(dealt, "bucket", buckets).mapInArrow(lean(run), PACKED)
    return _dealt(found, "part", parts).mapInArrow(lean(gather), "a long, b long")


# --- blocks ---------------------------------------------------------------------------------------


class Tree:
    """A signature tree: level 0 holds leaves of ``LEAF`` documents, each level above pairs of nodes."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        excess = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        at = np.arange(0, len(sizes), LEAF)
        self.bits, self.low, self.high, self.excess = [np.bitwise_or.reduceat(bits, at)], [np.minimum.reduceat(sizes, at)], [np.maximum.reduceat(sizes, at)], [np.maximum.reduceat(excess, at)]
        while len(self.low[-1]) > 1:
            at = np.arange(0, len(self.low[-1]), 2)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], at))
            self.low.append(np.minimum.reduceat(self.low[-1], at))
            self.high.append(np.maximum.reduceat(self.high[-1], at))
            self.excess.append(np.maximum.reduceat(self.excess[-1], at))


class Block:
    """Links among the documents of one block (or between two chunks), as union-find."""

    def __init__(self, docs: np.ndarray, sets: list[np.ndarray], bounds: Bounds, labels: np.ndarray | None = None):
        order = np.lexsort((docs, [len(s) for s in sets], [s[0] for s in sets]))
        self.docs, self.sets, self.bounds = docs[order], [sets[i] for i in order], bounds
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        n = len(docs)
        self.up = np.arange(n)
        if labels is not None:  # what is connected already
            _, first, back = np.unique(labels[order], return_index=True, return_inverse=True)
            self.up = first[back]
        width = 1 << int(np.clip(32 * self.sizes.mean(), 64, 16_384) - 1).bit_length()
        self.bits = np.zeros((n, width // 64), np.uint64)
        for i, s in enumerate(self.sets):
            b = s & np.uint64(width - 1)
            np.bitwise_or.at(self.bits[i], (b >> np.uint64(6)).astype(np.int64), np.uint64(1) << (b & np.uint64(63)))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return int(i)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up

    def verify(self, i: int, j: int) -> None:
        """Links two documents if their whole sets say so."""
        a, b = self.find(i), self.find(j)
        if a == b:
            return
        x, y = (self.sets[i], self.sets[j]) if self.sizes[i] <= self.sizes[j] else (self.sets[j], self.sets[i])
        at = np.searchsorted(y, x)
        both = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
        if self.bounds.den * both >= self.bounds.num * (len(x) + len(y) - both):
            self.up[max(a, b)] = min(a, b)

    def pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        """Document pairs: those whose sizes and bitmaps allow a link are verified."""
        for at in range(0, len(i), 4096):
            x, y = i[at : at + 4096], j[at : at + 4096]
            roots = self.roots()
            keep = roots[x] != roots[y]
            x, y = x[keep], y[keep]
            a, b = self.sizes[x], self.sizes[y]
            need = self.bounds.overlap(a, b)
            keep = np.minimum(a, b) >= need
            x, y, a, b, need = x[keep], y[keep], a[keep], b[keep], need[keep]
            p, q = self.bits[x], self.bits[y]
            most = np.minimum(a - np.bitwise_count(p & ~q).sum(1, dtype=np.int64), b - np.bitwise_count(q & ~p).sum(1, dtype=np.int64))
            keep = most >= need
            for u, v in zip(x[keep].tolist(), y[keep].tolist(), strict=True):
                self.verify(u, v)

    def leaves(self, x: np.ndarray, y: np.ndarray) -> None:
        """All document pairs of leaf pairs."""
        n, r = len(self.docs), np.arange(LEAF)
        for at in range(0, len(x), 2048):
            a, b = x[at : at + 2048], y[at : at + 2048]
            i = np.broadcast_to(a[:, None, None] * LEAF + r[None, :, None], (len(a), LEAF, LEAF)).ravel()
            j = np.broadcast_to(b[:, None, None] * LEAF + r[None, None, :], (len(a), LEAF, LEAF)).ravel()
            keep = (i < j) & (j < n)
            self.pairs(i[keep], j[keep])

    def join(self) -> None:
        n = len(self.docs)
        if n <= LEAF:
            self.leaves(np.zeros(1, np.int64), np.zeros(1, np.int64))
            return
        tree = Tree(self.bits, self.sizes)
        leaf = np.arange(-(-n // LEAF))
        self.leaves(leaf, leaf)
        self.leaves(leaf[:-1], leaf[1:])
        x, y = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.descend(tree, len(tree.low) - 1, x, y)

    def descend(self, tree: Tree, level: int, x: np.ndarray, y: np.ndarray) -> None:
        """Dual traversal of node pairs x <= y of one level, in slices of bounded size."""
        for at in range(0, len(x), 4096):
            a, b = self.allowed(tree, level, x[at : at + 4096], y[at : at + 4096])
            if not len(a):
                continue
            if level == 0:
                self.leaves(a, b)
                continue
            count = len(tree.low[level - 1])
            i = np.stack([2 * a, 2 * a, 2 * a + 1, 2 * a + 1], 1).ravel()
            j = np.stack([2 * b, 2 * b + 1, 2 * b, 2 * b + 1], 1).ravel()
            keep = (i <= j) & (j < count) & (i < count)
            self.descend(tree, level - 1, i[keep], j[keep])

    def allowed(self, tree: Tree, level: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node pairs that sizes, bitmaps and connections don't rule out."""
        low, high = tree.low[level], tree.high[level]
        num, den = self.bounds.num, self.bounds.den
        keep = (high[y] * den >= low[x] * num) & (high[x] * den >= low[y] * num)
        roots, span = self.roots(), LEAF << level
        starts = np.arange(0, len(roots), span)
        lo, hi = np.minimum.reduceat(roots, starts), np.maximum.reduceat(roots, starts)
        keep &= (lo[x] != hi[x]) | (lo[y] != hi[y]) | (lo[x] != lo[y])
        x, y = x[keep], y[keep]
        bits, excess = tree.bits[level], tree.excess[level]
        most = np.bitwise_count(bits[x] & bits[y]).sum(1, dtype=np.int64) + np.minimum(excess[x], excess[y])
        keep = (most >= self.bounds.overlap(low[x], low[y])) | (x == y)
        return x[keep], y[keep]

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, smallest document connected with it)."""
        roots = self.roots()
        least = np.full(len(roots), np.iinfo(np.int64).max)
        np.minimum.at(least, roots, self.docs)
        return self.docs, least[roots]


def _joined(bounds: Bounds):
    """Rows (block, doc, hashes, label), ordered by block, to links; one block in memory at a time."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        now, docs, sets, labels = None, [], [], []
        out = [[], []]

        def ended():
            if len(docs) > 1:
                block = Block(np.array(docs, np.int64), sets, bounds, np.array(labels, np.int64))
                block.join()
                a, b = block.stars()
                keep = a != b
                out[0].append(a[keep])
                out[1].append(b[keep])

        def told():
            a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in out)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in text_batches(batches):
            for block, doc, hashes, label in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if block != now:
                    ended()
                    now, docs, sets, labels = block, [], [], []
                docs.append(doc)
                sets.append(np.frombuffer(hashes, np.uint64))
                labels.append(label)
            if sum(map(len, out[0])) > 100_000:
                yield told()
                out = [[], []]
        ended()
        yield told()

    return run


def _traversed(rows: DataFrame, bounds: Bounds) -> DataFrame:
    """Links found in blocks; rows has (block, doc, hashes, label)."""
    dealt = rows.select("block", "doc", "hashes", "label").repartition("block").sortWithinPartitions("block", "doc")
    return dealt.mapInArrow(lean(_joined(bounds)), "a long, b long")


# --- the join -------------------------------------------------------------------------------------


def jaccard_components(df: DataFrame, width: int = 5, num: int = 75, den: int = 100, most: int = 2_000_000, most_docs: int = 10_000, most_hashes: int = 500_000, id_col: str = "doc_id", text_col: str = "text", carried_col: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id is the smallest id it is linked to.

    ``carried_col``, a long column, comes along as ``carried``.
    """
    spark, bounds = df.sparkSession, Bounds(num, den)
    folder = new_folder(spark, "jaccard")
    carried = F.lit(None) if carried_col is None else F.col(carried_col)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), carried.cast("long").alias("carried"))

    def keys(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingles = Shingles(width)
        for batch in text_batches(batches):
            found = [shingles(t) for t in batch.column(1).to_pylist()]
            with np.errstate(over="ignore"):
                k1 = np.array([s.sum(dtype=np.uint64) for s in found], np.uint64)
                k2 = np.array([mixed(s ^ STEP).sum(dtype=np.uint64) for s in found], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), batch.column(2)], names=["doc_id", "n", "k1", "k2", "carried"])

    keyed = written(rows.mapInArrow(lean(keys), "doc_id long, n long, k1 long, k2 long, carried long"), f"{folder}/keys")
    classes = written(keyed.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep")).where("rep is not null"), f"{folder}/classes")

    n = F.col("n")
    floor = lambda x: F.floor(x).cast("long")
    least = floor((n * num + den - 1) / den)
    shared = lambda x: F.greatest(F.lit(1), floor(x * SHARED / 100))
    hashes = keyed.agg(F.sum(F.least(n, n - least + shared(n)))).first()[0] or 0
    buckets = max(1, -(-hashes // most_hashes))

    rows = rows.select("doc_id", "text")

    def wide(batches: Iterator) -> Iterator:
        shingles = Shingles(width)

        def prefixes():
            for batch in text_batches(batches):
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    s = shingles(text)
                    if len(s) and doc is not None:
                        yield doc, s[: bounds.wide(len(s))]

        yield from _deal(prefixes(), buckets, True)

    credits = _meet(rows.mapInArrow(lean(wide), DEALT), True, buckets).withColumnRenamed("b", "shared")
    needed = F.least(shared(least), F.least(n, n - least + shared(n)))
    candidates = written(classes.join(credits, F.col("rep") == F.col("a")).where(F.col("shared") >= needed).select("rep", "n"), f"{folder}/candidates")

    def members(of: DataFrame) -> DataFrame:
        """(doc, n, hashes) of all documents in ``of``, and of a few more."""
        bits, places = _bitmap(of)

        def sets(batches: Iterator) -> Iterator:
            import zlib

            import pyarrow as pa

            shingles, bitmap = Shingles(width), np.frombuffer(zlib.decompress(bits), np.uint8)
            for batch in text_batches(batches):
                ids = np.array(batch.column(0).to_pylist(), np.int64)
                h = _place(ids, places)
                maybe = np.flatnonzero(bitmap[h >> 3] >> (h & 7).astype(np.uint8) & 1)
                if len(maybe):
                    part = batch.take(pa.array(maybe))
                    found = [shingles(t) for t in part.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["doc", "n", "hashes"])

        return rows.where("doc_id is not null").mapInArrow(lean(sets), "doc long, n long, hashes binary")

    def narrow(batches: Iterator) -> Iterator:
        def prefixes():
            for batch in text_batches(batches):
                for doc, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield doc, bounds.keys(np.frombuffer(hashes, np.uint64))

        yield from _deal(prefixes(), buckets, False)

    stars = _meet(members(candidates.select("rep")).select("doc", "hashes").mapInArrow(lean(narrow), DEALT), False, buckets)
    blocks = written(components(stars, f"{folder}/blocks"), f"{folder}/labels")
    links = components(_blocks(members(blocks.select("node")), candidates, blocks, bounds, most, most_docs, folder), f"{folder}/links")
    links = written(links, f"{folder}/components")

    reps = classes.join(links.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", "n", F.coalesce("component", "rep").alias("component_id"))
    reps = written(reps, f"{folder}/result")
    removed(*(f"{folder}/{x}" for x in ("classes", "candidates", "blocks", "labels", "sizes", "places", "large", "first", "connected", "connected-labels", "open", "ranged", "ranges", "links", "components")))
    found = keyed.join(reps, ["k1", "k2", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "carried")
    return found if carried_col else found.drop("carried")


def keep_one(df: DataFrame, width: int = 5, num: int = 75, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of one row of each group of linked texts: the one of smallest id (rows without an id last).

    Rows are told apart by id and text (a hash of 64 bits of both), so two texts of one id are two documents,
    and rows without an id take part.  Of rows that repeat in id and text one stays.  Texts without words
    are linked with nothing and all stay.  Columns keep their names, whatever they are called.
    """
    folder = new_folder(df.sparkSession, "kept")
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    packed = packed.withColumn("node", F.xxhash64("id", "text"))
    found = jaccard_components(packed, width, num, den, id_col="node", carried_col="id").where("n_shingles > 0")
    # narrow rows; copies are counted before anything is shuffled
    nodes = written(found.groupBy(F.col("doc_id").alias("node"), F.col("component_id").alias("group"), F.col("carried").alias("id")).agg(F.count("*").alias("n")), f"{folder}/nodes")
    first = nodes.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("first")).select("group", F.col("first.node").alias("first"))
    judged = written(nodes.join(first, "group").select("node", "n", (F.col("node") == F.col("first")).alias("stays")), f"{folder}/judged")
    gone = judged.where("not stays").select("node")
    maybe = _maybe(F.col("node"), gone)
    # most rows are known to stay without being shuffled
    kept = packed.where(~maybe).unionByName(packed.where(maybe).join(gone, "node", "left_anti"))
    again = judged.where("stays and n > 1").select("node")
    if again.limit(1).count():
        kept = kept.join(again, "node", "left_anti").unionByName(kept.join(again, "node", "left_semi").dropDuplicates(["node"]))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in df.columns])


def _place(ids: np.ndarray, places: int) -> np.ndarray:
    return (mixed(ids.view(np.uint64)) % np.uint64(places)).astype(np.int64)


def _bitmap(ids: DataFrame, place=_place, least: int = 1 << 20, most: int = 1 << 28) -> tuple[bytes, int]:
    """A compressed bitmap with a bit for every id, and its number of places: 16 to 32 for each id within
    ``least`` and ``most`` (32 MB; from some 100 million ids on it lets ever more through).  What it lets
    through is joined, so it only saves work."""
    import zlib

    places = min(most, max(least, 1 << (16 * ids.count()).bit_length()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits = np.zeros(places // 8, np.uint8)
        for batch in batches:
            h = place(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), places)
            np.bitwise_or.at(bits, h >> 3, np.uint8(1) << (h & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())], names=["bits"])

    bits = np.zeros(places // 8, np.uint8)
    for r in ids.coalesce(4).mapInArrow(lean(run), "bits binary").collect():
        bits |= np.frombuffer(zlib.decompress(r.bits), np.uint8)
    return zlib.compress(bits.tobytes(), 1), places


def _maybe(node: Column, ids: DataFrame) -> Column:
    """Whether a node may be one of ``ids`` (all of them and a few others): a bitmap looked up in the JVM.

    Nodes are hashes, so that their remainder is a place."""
    import zlib

    bits, places = _bitmap(ids, lambda h, n: h % n)
    held = ids.sparkSession.createDataFrame([(bytearray(zlib.decompress(bits)),)], "bits binary").scalar()
    at = F.pmod(node, F.lit(places))
    byte = F.conv(F.hex(F.substring(held, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2)) == 1


def _blocks(members: DataFrame, sizes: DataFrame, blocks: DataFrame, bounds: Bounds, most: int, most_docs: int, folder: str) -> DataFrame:
    """Links of all blocks: those of bounded size at once, larger ones chunk by chunk."""
    counted = blocks.join(sizes, F.col("node") == F.col("rep")).groupBy("component").agg(F.count("*").alias("docs"), F.sum("n").alias("hashes"))
    counted = written(counted.withColumn("chunks", F.greatest(F.ceil(F.col("docs") / most_docs), F.ceil(F.col("hashes") / most)).cast("long")), f"{folder}/sizes")
    places = written(blocks.join(counted.select("component", "chunks"), "component"), f"{folder}/places")
    placed = members.join(places, F.col("doc") == F.col("node")).drop("node")
    chunk = lambda seed: F.pmod(F.xxhash64("doc", F.lit(seed)), F.col("chunks"))
    own = F.col("doc").alias("label")
    whole = _traversed(placed.where("chunks = 1").select(F.xxhash64("component", F.lit(0)).alias("block"), "doc", "hashes", own), bounds)
    if counted.where("chunks > 1").limit(1).count() == 0:
        return whole
    large = written(placed.where("chunks > 1"), f"{folder}/large")
    dealt = [large.select(F.xxhash64("component", F.lit(seed), chunk(seed)).alias("block"), "doc", "hashes", own) for seed in (1, 2)]
    first = written(whole.unionByName(_traversed(dealt[0].unionByName(dealt[1]), bounds)), f"{folder}/first")

    labels = written(components(first, f"{folder}/connected"), f"{folder}/connected-labels").withColumnRenamed("component", "label")
    large = large.join(labels, F.col("doc") == F.col("node"), "left").withColumn("label", F.coalesce("label", "doc")).drop("node")
    open_ = large.groupBy("component").agg((F.min("label") < F.max("label")).alias("open")).where("open").select("component")
    # chunks of neighbouring sizes: each document meets its own chunk and those above whose sizes can link
    rest = written(large.join(open_, "component", "left_semi"), f"{folder}/open")
    cuts = rest.groupBy("component").agg(F.percentile_approx("n", [x / 65 for x in range(1, 65)], 1000).alias("cuts"))
    # as many size ranges as chunks are needed, and ranges of too many documents of like size in pieces
    step = F.floor(F.size(F.filter("cuts", lambda c: c < F.col("n"))) * F.col("chunks") / 65).cast("int")
    rest = rest.join(cuts, "component").withColumn("step", step).drop("cuts")
    pieces = rest.groupBy("component", "step").agg(F.greatest(F.ceil(F.sum("n") / most), F.ceil(F.count("*") / most_docs)).cast("long").alias("pieces"))
    rest = written(rest.join(pieces, ["component", "step"]).withColumn("fine", F.pmod(F.xxhash64("doc", F.lit(3)), F.col("pieces"))), f"{folder}/ranged")
    ranges = written(rest.groupBy("component", "step", "fine").agg(F.min("n").alias("low"), F.max("n").alias("high")), f"{folder}/ranges")
    x, y = ranges.alias("x"), ranges.alias("y")
    order = lambda t: F.struct(f"{t}.step", f"{t}.fine")
    meet = x.join(y, F.col("x.component") == F.col("y.component")).where((order("x") <= order("y")) & (F.col("x.high") * bounds.den >= F.col("y.low") * bounds.num) & (F.col("y.high") * bounds.den >= F.col("x.low") * bounds.num))
    meet = meet.select(F.col("x.component").alias("component"), F.struct("x.step", "x.fine").alias("p"), F.struct("y.step", "y.fine").alias("q"))
    sides = meet.select("component", "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("side"))
    pairs = rest.withColumn("side", F.struct("step", "fine")).join(sides, ["component", "side"]).select(F.xxhash64("component", "p", "q").alias("block"), "doc", "hashes", "label")
    return first.unionByName(_traversed(pairs, bounds))
