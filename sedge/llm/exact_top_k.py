"""Exact top-k inner-product search by the threshold algorithm.

Vectors are turned into integers, floor(scale * x) in double precision.  A task gathers units of a bounded
number of vectors and sorts each dimension once; for a query it walks all lists from the end that the
sign of the query's component favours, scores every vector it meets in full, and stops as soon as the
sum of the components at the present depth (what an unseen vector could reach at best) is below the k-th
score, or every vector has been met.  Equal scores go to the smaller id, so a bound that equals the k-th
score does not stop the walk.

Queries lie in the shared folder in files of a thousand, which every task reads in turn; vectors are read
once and never shuffled, only each unit's k best of each query.

Defined cases: a null id or vector, and one with a null or non-finite component, takes no part; a query
never finds rows of its own id; an id that is a query twice is asked once (its smallest vector); repeated
candidates are each found; a shorter vector counts as followed by zeros; an empty table gives an empty
result; integers must stay below 2**20; other columns are left out, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import filesystem, lean, new_folder, text_batches

FOUND = "query_id long, vec_id long, score long"


def integers(vectors: list, scale: int) -> np.ndarray:
    """Rows of floor(scale * x) as exact doubles, shorter ones filled with zeros."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(np.asarray(v, np.float64) * scale)
    return out


class Lists:
    """Sorted lists of each dimension over a unit of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by], np.ascontiguousarray(vectors[by])
        self.order = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32).T.copy()
        self.steps = 0

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, best first, ties to the smaller id."""
        n = len(self.ids)
        width = min(len(query), self.vectors.shape[1])
        dims = np.flatnonzero(query[:width])
        q = np.zeros(self.vectors.shape[1])
        q[:width] = query[:width]
        seen = self.ids == query_id
        left = n - int(seen.sum())
        best_rows, best = np.empty(0, np.int64), np.empty(0)
        if not len(dims):  # every score is zero
            rows = np.flatnonzero(~seen)[:k]
            return self.ids[rows], np.zeros(len(rows), np.int64)
        lists = [self.order[j][::-1] if query[j] > 0 else self.order[j] for j in dims]
        depth, step = 0, 16
        while left and depth < n:
            end = min(n, depth + step)
            met = np.zeros(n, bool)
            for rows in lists:
                met[rows[depth:end]] = True
            met &= ~seen
            new = np.flatnonzero(met)
            self.steps += end - depth
            if len(new):
                seen |= met
                left -= len(new)
                rows, scores = np.concatenate([best_rows, new]), np.concatenate([best, self.vectors[new] @ q])
                take = np.lexsort((rows, -scores))[:k]  # rows are in id order
                best_rows, best = rows[take], scores[take]
            bound = sum(query[j] * self.vectors[rows[end - 1], j] for j, rows in zip(dims, lists, strict=True))
            if len(best) == k and best[-1] > bound:
                break
            depth, step = end, step * 2
        return self.ids[best_rows], best.astype(np.int64)


def top_k(df: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, unit: int = 32_768, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best among all rows but its own."""
    spark = df.sparkSession
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = df.where(F.col(id_col).isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
    folder = new_folder(spark, "queries")
    asked = rows.where(is_query).select(F.col(id_col).cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding"))
    asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).write.option("maxRecordsPerFile", 1000).parquet(folder)

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        fs, top = filesystem(folder)
        files = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(top)) if i.base_name.startswith("part-"))

        def answered(ids: list, vectors: list) -> Iterator:
            lists = Lists(np.array(ids, np.int64), integers(vectors, scale))
            for path in files:
                table = pq.read_table(path, filesystem=fs)
                found = [[], [], []]
                for query_id, v in zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist(), strict=True):
                    got, scores = lists.top(query_id, integers([v], scale)[0], k)
                    found[0].append(np.full(len(got), query_id, np.int64))
                    found[1].append(got)
                    found[2].append(scores)
                if found[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], names=["query_id", "vec_id", "score"])

        ids, vectors = [], []
        for batch in text_batches(batches, 2048):
            ids += batch.column(0).to_pylist()
            vectors += batch.column(1).to_pylist()
            if len(ids) >= unit:
                yield from answered(ids, vectors)
                ids, vectors = [], []
        if ids:
            yield from answered(ids, vectors)

    found = rows.select(F.col(id_col).cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).mapInArrow(lean(search), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
