"""Benchmark decontamination with an FM-index per training shard.

A shard is what one task reads, up to a bound of symbols and text bytes; then its index is searched and
a new one begun.  Words that no test item has can't lie in an occurrence, nor can runs of test words that
are shorter than the shortest window, so the indexed text is the remaining runs, each ended by a
separator; a fixed-size bitmap of test words (false positives only cost index space) decides.  The index
is the Burrows-Wheeler transform of that text in a wavelet matrix; all windows are searched backward at
once, occurrences are located by steps to sampled suffix positions, and their word spans are merged.

The test items lie in the shared folder in files of a thousand; every task reads them file by file, so
neither the driver nor a task holds them all (a few files' windows are kept from one shard to the next), and
the documents are read once and never shuffled.  Where a removal joins the words on both sides of it, the
words around the seams are indexed and searched in the same way, until nothing is found.

Defined cases: a null text has no words; items without words or without an id are left out; an item
id that occurs twice counts once; null doc ids are passed through; repeated rows give repeated results;
without items, or documents, nothing is hit; other columns are left out, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import filesystem, lean, new_folder, text_batches

WINDOW, BITS, KEPT = 10, 1 << 23, 2
SEPARATED = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Lower-cases A-Z and makes every other ASCII byte but 0-9 and a-z a blank.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

HITS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,end:long>>, items array<long>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TO_WORDS).split() if text else []


def windows_of(words: list[bytes], width: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All runs of ``width`` words; of a shorter text the whole."""
    if len(words) < width:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]


class WaveletMatrix:
    """Rank queries over a sequence of small integers, a bit vector for each level."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels, self.n = max(1, int(top).bit_length()), len(sequence)
        self.words, self.ones, self.zeros = [], [], []
        s = sequence
        for level in range(self.levels - 1, -1, -1):
            bit = ((s >> level) & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate([bit, np.zeros(-len(bit) % 64 + 64, np.uint8)]), bitorder="little").view("<u8")
            self.words.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(len(bit) - int(bit.sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        word, rest = i >> 6, (i & 63).astype(np.uint64)
        return self.ones[k][word] + np.bitwise_count(self.words[k][word] & ((np.uint64(1) << rest) - np.uint64(1)))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position i."""
        start = np.zeros_like(i)
        for k in range(self.levels):
            bit = (symbol >> (self.levels - 1 - k)) & 1 == 1
            a, b = self._ones(k, start), self._ones(k, i)
            start, i = np.where(bit, self.zeros[k] + a, start - a), np.where(bit, self.zeros[k] + b, i - b)
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        """The symbols at positions i."""
        got = np.zeros_like(i)
        for k in range(self.levels):
            bit = (self.words[k][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1
            a = self._ones(k, i)
            got, i = got * 2 + bit, np.where(bit, self.zeros[k] + a, i - a)
        return got


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling."""
    n = len(s)
    _, rank = np.unique(s, return_inverse=True)
    rank, width = rank.astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank, width = new, width * 2
        if rank.max() == n - 1 or width >= n:
            return order


class FMIndex:
    """Backward search and location over a sequence of symbols from 1 on."""

    def __init__(self, symbols: np.ndarray, step: int = 16):
        s = np.concatenate([symbols, [0]]).astype(np.int64)
        order = suffix_array(s)
        self.n, top = len(s), int(s.max())
        self.tree = WaveletMatrix(s[order - 1], top)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=top + 1))]).astype(np.int64)
        self.sampled = order % step == 0
        self.before = np.concatenate([[0], np.cumsum(self.sampled)])
        self.positions = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of phrases, one in each row (all of one length)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for column in phrases.T[::-1]:
            c = column.astype(np.int64)
            lo, hi = self.first[c] + self.tree.rank(c, lo), self.first[c] + self.tree.rank(c, hi)
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by backward steps to the next sampled one."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            here = rows[open_]
            done = self.sampled[here]
            out[open_[done]] = self.positions[self.before[here[done]]] + steps[open_[done]]
            open_ = open_[~done]
            if len(open_):
                c = self.tree.access(rows[open_])
                rows[open_] = self.first[c] + self.tree.rank(c, rows[open_])
                steps[open_] += 1
        return out


class Shard:
    """Documents gathered for one index."""

    def __init__(self, flags: dict, least: int):
        self.flags, self.least = flags, least
        self.ids: dict[bytes, int] = {}
        self.text, self.runs, self.docs, self.size = [], [], [], 0
        self.find = re.compile(rb"\x01{%d,}" % least).finditer

    def add(self, words: list[bytes]) -> None:
        doc = len(self.docs)
        self.docs.append(len(words))
        ids = self.ids
        for m in self.find(bytes(map(self.flags.__getitem__, words))):
            a, b = m.span()
            self.runs.append((self.size, doc, a))
            self.text += [ids.setdefault(w, len(ids) + 2) for w in words[a:b]]
            self.text.append(1)
            self.size += b - a + 1

    def occurrences(self, blocks) -> Iterator[tuple[int, int, int, list]]:
        """(document, first word, words, item ids) of every occurrence of a window."""
        if not self.size:
            return
        index, runs = FMIndex(np.array(self.text)), np.array(self.runs, np.int64)
        for windows in blocks:
            for width, of in windows.items():
                known = [(w, items) for w, items in of.items() if all(x in self.ids for x in w)]
                if not known:
                    continue
                lo, hi = index.search(np.array([[self.ids[x] for x in w] for w, _ in known], np.int64))
                found = np.flatnonzero(hi > lo)
                for at in range(0, len(found), 4096):
                    part = found[at : at + 4096]
                    counts = hi[part] - lo[part]
                    rows = np.repeat(lo[part], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    where = index.locate(rows)
                    run = np.searchsorted(runs[:, 0], where, side="right") - 1
                    for k, d, w in zip(np.repeat(part, counts).tolist(), runs[run, 1].tolist(), (where - runs[run, 0] + runs[run, 2]).tolist(), strict=True):
                        yield d, w, width, known[k][1]


class _Flags(dict):
    """Whether a word may be a test word; holds a bounded number of words."""

    def __init__(self, bitmap: np.ndarray):
        super().__init__()
        self.bitmap = bitmap

    def __missing__(self, word: bytes) -> bool:
        h = zlib.crc32(word) % BITS
        got = bool(self.bitmap[h >> 3] >> (h & 7) & 1)
        if len(self) >= 500_000:
            self.clear()
        if len(word) <= 64:
            self[word] = got
        return got


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans united where they meet or overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class TestItems:
    """The windows of the test items, kept in the shared folder in files of a thousand items."""

    def __init__(self, items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW):
        spark = items.sparkSession
        self.folder, self.width = new_folder(spark, "test-items"), width
        self.files, self.kept = None, []
        kept = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null and text is not null")
        kept.write.option("maxRecordsPerFile", 1000).parquet(self.folder)

        def scan(batches: Iterator) -> Iterator:
            import pyarrow as pa

            bits, least = np.zeros(BITS // 8, np.uint8), width
            for batch in text_batches(batches):
                for text in batch.column(0).to_pylist():
                    words = words_of(text)
                    least = min(least, len(words) or width)
                    for w in set(words):
                        h = zlib.crc32(w) % BITS
                        bits[h >> 3] |= 1 << (h & 7)
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary()), pa.array([least], pa.int64())], names=["bits", "least"])

        # four bitmaps of fixed size come to the driver
        found = spark.read.parquet(self.folder).select("text").coalesce(4).mapInArrow(scan, "bits binary, least long").collect()
        bits = np.zeros(BITS // 8, np.uint8)
        for r in found:
            bits |= np.frombuffer(zlib.decompress(r.bits), np.uint8)
        self.bits, self.least = zlib.compress(bits.tobytes(), 6), min([width, *(r.least for r in found)])

    def flags(self) -> _Flags:
        return _Flags(np.frombuffer(zlib.decompress(self.bits), np.uint8))

    def blocks(self) -> Iterator[dict[int, dict[tuple, list]]]:
        """Of each file: by width, window to the ids of the items that have it.

        A task keeps what it has read of the first ``KEPT`` files.
        """
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        fs, top = filesystem(self.folder)
        if self.files is None:
            self.files = sorted(x.path for x in fs.get_file_info(pafs.FileSelector(top)) if x.base_name.startswith("part-"))
        for k, path in enumerate(self.files):
            if k < len(self.kept):
                yield self.kept[k]
                continue
            table, windows = pq.read_table(path, filesystem=fs), defaultdict(lambda: defaultdict(list))
            for item, text in zip(table["item_id"].to_pylist(), table["text"].to_pylist(), strict=True):
                for w in windows_of(words_of(text), self.width):
                    windows[len(w)][w].append(item)
            if k == len(self.kept) < KEPT:
                self.kept.append(windows)
            yield windows


def _searched(batches: Iterator, column: int, items: TestItems, most_symbols: int, most_bytes: int) -> Iterator:
    """(record batches, per document: words, merged spans, item ids) shard by shard."""
    flags, shard, held, size = items.flags(), None, [], 0

    def ended():
        spans, names = defaultdict(list), defaultdict(set)
        for doc, at, width, ids in shard.occurrences(items.blocks()):
            spans[doc].append((at, at + width))
            names[doc].update(ids)
        return held, [(n, merged(spans[d]) if d in spans else [], sorted(names[d], key=str) if d in names else []) for d, n in enumerate(shard.docs)]

    for batch in text_batches(batches):
        if shard is None:
            shard = Shard(flags, items.least)
        for text in batch.column(column).to_pylist():
            shard.add(words_of(text))
        held.append(batch)
        size += batch.nbytes
        if shard.size >= most_symbols or size >= most_bytes:
            yield ended()
            shard, held, size = None, [], 0
    if shard is not None:
        yield ended()


def contamination(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", most_symbols: int = 1_000_000, most_bytes: int = 48 << 20) -> DataFrame:
    """Per document: words, words within occurrences, items that occur, and the merged removal spans."""
    tests = TestItems(items, item_id_col, item_text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for held, results in _searched(batches, 1, tests, most_symbols, most_bytes):
            at = 0
            for batch in held:
                part = results[at : at + batch.num_rows]
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([n for n, _, _ in part], pa.int64()),
                        pa.array([sum(b - a for a, b in s) for _, s, _ in part], pa.int64()),
                        pa.array([len(i) for _, _, i in part], pa.int64()),
                        pa.array([hashlib.sha256(",".join(map(str, i)).encode()).hexdigest() for _, _, i in part]),
                        pa.array([bool(s) for _, s, _ in part]),
                        pa.array([[{"start": a, "end": b} for a, b in s] for _, s, _ in part], spans_type),
                        pa.array([i for _, _, i in part], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items"],
                )

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lean(run), HITS)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with the given word spans cut out, from a span's first to its last word."""
    raw = text.encode()
    places = [m.span() for m in SEPARATED.finditer(raw.lower())]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def _seams(words: list[bytes], spans: list[tuple[int, int]], width: int) -> list[bytes]:
    """The words that are left, those too far from every removed span to be in a new window blanked."""
    near, gone = set(), 0
    for a, b in spans:
        near.update(range(a - gone - width + 1, a - gone + width - 1))
        gone += b - a
    return [w if i in near else b" " for i, w in enumerate(words)]


def _cut(texts: dict[int, str], spans: dict[int, list[tuple[int, int]]], items: TestItems, flags: _Flags) -> dict[int, str]:
    """Texts without their spans, and without what the removals have joined to occurrences."""
    while spans:
        order, shard = sorted(spans), Shard(flags, items.least)
        for i in order:
            texts[i] = without_spans(texts[i], spans[i])
            shard.add(_seams(words_of(texts[i]), spans[i], items.width))
        found = defaultdict(list)
        for doc, at, width, _ in shard.occurrences(items.blocks()):
            found[order[doc]].append((at, at + width))
        spans = {i: merged(s) for i, s in found.items()}
    return texts


def decontaminate(df: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", most_symbols: int = 1_000_000, most_bytes: int = 48 << 20) -> DataFrame:
    """All rows and columns, with every occurrence cut out of the text.

    Cutting joins the words on both sides; where that makes a new occurrence it is cut too.  Null and empty
    texts, and those without an occurrence, stay as they are; so do repeated rows and all other columns.
    """
    tests, column = TestItems(items, item_id_col, item_text_col), df.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        flags = tests.flags()
        for held, results in _searched(batches, column, tests, most_symbols, most_bytes):
            at = 0
            for batch in held:
                hit = {i: spans for i, (_, spans, _) in enumerate(results[at : at + batch.num_rows]) if spans}
                texts = batch.column(column).to_pylist()
                for i, text in _cut({i: texts[i] for i in hit}, hit, tests, flags).items():
                    texts[i] = text
                at += batch.num_rows
                columns = list(batch.columns)
                columns[column] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([f.with_type(pa.string()) if k == column else f for k, f in enumerate(batch.schema)]))

    return df.mapInArrow(lean(run), df.schema)
