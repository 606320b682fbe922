"""Quality scores by a generalised additive model with pairwise interactions.

Each feature is cut into bins.  Boosting visits the features in turn and adds to each one's lookup table
a small step of a shallow tree fitted to the present residuals (logistic loss); then the pairs whose
residuals a tree of one cut in each direction explains best get two-way tables in the same manner.  A
score is the logistic of an intercept and one table entry for each feature and pair: all documents of a
batch at once, by bin numbers.

The model is fitted on the driver to the features of at most ``sample`` labelled rows (those with the
smallest hash of their id), which is the only thing that is bounded; scoring covers every whole text.
Features are made of the text alone.

Defined cases: a null text counts as empty, and an empty text has a score like any other; null labels
and labels of unknown documents are left out; of an id's several labels the largest counts; without any
label, or with one kind only, the score is the share of ones (0.5 without any); a null id is passed
through and held out; repeated rows give repeated results; other columns are left out, so their names
can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import lean, text_batches

#: Frequent short words of a few languages: their share tells prose from lists.
FREQUENT = frozenset("the of and to in is that it for on with as be by this are from or an at de la le les des et en un une du que pour dans qui sur par est el los las y del se por con una der die das und von den mit zu dem nicht ein eine auf ist im für sich".split())
FEATURES = ["log_words", "word_length", "distinct_words", "repeated_words", "upper_words", "frequent_words", "odd_symbols", "bars", "digits", "exclamations", "capitals", "lines", "repeated_lines", "distinct_halves", "longest_word", "end_marks"]


def features(text: str) -> list[float]:
    """The features of a whole text, in the order of ``FEATURES``."""
    words = text.split()
    n = len(words)
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = max(1, int(raw.sum()))
    per = max(1, n)
    symbols = int(raw[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 123, 125, 126]].sum())
    lines = [x for x in text.split("\n") if x]
    half = {w.casefold() for w in words[: n // 2]}
    rest = {w.casefold() for w in words[n // 2 :]}
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / per,
        len(set(words)) / per,
        sum(map(eq, words, words[1:])) / per,
        sum(map(str.isupper, words)) / per,
        sum(map(FREQUENT.__contains__, words)) / per,
        symbols / size,
        int(raw[124]) / per,
        int(raw[48:58].sum()) / size,
        int(raw[33]) / per,
        int(raw[65:91].sum()) / size,
        len(lines) / per,
        1 - len(set(lines)) / max(1, len(lines)),
        len(rest - half) / max(1, len(rest)),
        float(max(map(len, words), default=0)),
        int(raw[[46, 63, 58, 59]].sum()) / per,
    ]


@dataclass
class Model:
    """Lookup tables on binned features."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        z = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values at even quantiles."""
    q = np.unique(np.quantile(v, np.arange(1, bins) / bins, method="lower")) if len(v) else np.empty(0)
    return q[q > v.min()] if len(q) else q


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float, ridge: float) -> np.ndarray:
    """Newton steps of a tree of few leaves over ordered bins, by best first cuts."""
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

    def best(a: int, b: int):
        c = np.arange(a + 1, b)
        if not len(c):
            return 0.0, -1
        gl, hl, gt, ht = gs[c] - gs[a], hs[c] - hs[a], gs[b] - gs[a], hs[b] - hs[a]
        gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
        gain[(hl < least) | (ht - hl < least)] = 0
        k = int(np.argmax(gain))
        return float(gain[k]), int(c[k])

    parts = [(0, len(g), *best(0, len(g)))]
    while len(parts) < leaves:
        k = max(range(len(parts)), key=lambda i: parts[i][2])
        a, b, gain, c = parts[k]
        if gain <= 1e-12:
            break
        parts[k : k + 1] = [(a, c, *best(a, c)), (c, b, *best(c, b))]
    out = np.zeros(len(g))
    for a, b, _, _ in parts:
        out[a:b] = -(gs[b] - gs[a]) / (hs[b] - hs[a] + ridge)
    return out


def _square(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best tree of one cut in each direction over a two-way table: (gain, steps)."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    quarter = lambda s: (s, s[-1:, :] - s, s[:, -1:] - s, s[-1, -1] - s[-1:, :] - s[:, -1:] + s)
    gain = sum(a**2 / (b + ridge) for a, b in zip(quarter(gs), quarter(hs), strict=True))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, columns] = -g[rows, columns].sum() / (h[rows, columns].sum() + ridge)
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, leaves: int = 3, rate: float = 0.1, n_pairs: int = 6, pair_bins: int = 12, pair_rounds: int = 40, ridge: float = 1.0, least: float = 1.0) -> Model:
    """Cyclic boosting of the features' tables, then of the best pairs' tables."""
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        return Model(intercept=float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    model = Model(intercept=float(np.log(share / (1 - share))))
    model.cuts = [_edges(v, bins) for v in x.T]
    model.coarse = [_edges(v, pair_bins) for v in x.T]
    binned = [np.searchsorted(c, v, side="right") for c, v in zip(model.cuts, x.T, strict=True)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    z = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j, b in enumerate(binned):
            g, h = slopes()
            n = len(model.tables[j])
            step = rate * _tree(np.bincount(b, g, n), np.bincount(b, h, n), leaves, least, ridge)
            model.tables[j] += step
            z += step[b]
    wide = [np.searchsorted(c, v, side="right") for c, v in zip(model.coarse, x.T, strict=True)]
    two_way = lambda i, j, v: np.bincount(wide[i] * (len(model.coarse[j]) + 1) + wide[j], v, (len(model.coarse[i]) + 1) * (len(model.coarse[j]) + 1)).reshape(len(model.coarse[i]) + 1, -1)
    g, h = slopes()
    ranked = sorted(((-_square(two_way(i, j, g), two_way(i, j, h), ridge)[0], i, j) for i in range(x.shape[1]) for j in range(i + 1, x.shape[1])))
    model.pairs = [(i, j) for _, i, j in ranked[:n_pairs]]
    model.pair_tables = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            g, h = slopes()
            step = rate * _square(two_way(i, j, g), two_way(i, j, h), ridge)[1]
            model.pair_tables[k] += step
            z += step[wide[i], wide[j]]
    # tables are centred on the sample, so that each one's part of a score stands for itself
    for j, b in enumerate(binned):
        mean = float(model.tables[j][b].mean())
        model.tables[j] -= mean
        model.intercept += mean
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text is a multiple of 5 (null ids too)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """The model learnt from at most ``sample`` labelled documents that are not held out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    # bounded: at most ``sample`` ids and labels are broadcast
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "label", "text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in text_batches(batches):
            values = [features(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.float64()))], names=["id", "label", "x"])

    # rows of repeated ids count once, so the driver gets at most ``sample`` short arrays
    found = rows.mapInArrow(lean(run), "id long, label int, x array<double>").groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x").collect()
    found.sort(key=lambda r: r.id)
    x = np.array([r.x for r in found], np.float64).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r.label for r in found], np.float64))


def score_quality(df: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text; one narrow pass."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in text_batches(batches):
            s = model.scores(np.array([features(t or "") for t in batch.column(2).to_pylist()], np.float64).reshape(batch.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")).mapInArrow(lean(run), "doc_id long, held_out boolean, score double, predicted int")


def keep_quality(df: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """All rows and columns of documents that score ``threshold`` or more."""
    column = df.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in text_batches(batches):
            s = model.scores(np.array([features(t or "") for t in batch.column(column).to_pylist()], np.float64).reshape(batch.num_rows, len(FEATURES)))
            yield batch.filter(pa.array(s >= threshold))

    return df.mapInArrow(lean(run), df.schema)
