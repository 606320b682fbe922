"""Exact nearest neighbours, grouping of results, a deterministic encoder."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def nearest(vectors: DataFrame, query: list[float], k: int = 20, metric: str = "l2") -> DataFrame:
    """(vec_id, distance) of one query's k nearest; per-partition heaps, no shuffle of vectors."""
    q = F.array(*[F.lit(float(x)) for x in query])
    distance = l2(F.col("embedding"), q) if metric == "l2" else 1 - cosine(F.col("embedding"), q)
    return vectors.select("vec_id", "label", distance.alias("distance")).orderBy("distance", "vec_id").limit(k)


def grouped(found: DataFrame, by: str = "label") -> DataFrame:
    return found.groupBy(by).agg(F.min("distance").alias("best"), F.count("*").alias("n"))


def hashed_embedding(df: DataFrame, dims: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, embedding): a unit vector of hashed words, the stand-in encoder where no model is injected."""

    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = np.zeros((batch.num_rows, dims))
            for i, t in enumerate(batch.column(1).to_pylist()):
                words = (t or "").lower().split()
                if words:
                    out[i] = np.bincount([zlib.crc32(w.encode()) % dims for w in words], minlength=dims)
                    out[i] /= np.linalg.norm(out[i])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(out), pa.list_(pa.float64()))], names=["doc_id", "embedding"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, embedding array<double>")


def nearest_of_each(vectors: DataFrame, questions: DataFrame, k: int = 20, digits: int = 6) -> DataFrame:
    """(query_id, vec_id, distance, rank): each question's k nearest by squared distance, rounded for ties.

    Questions (query_id, question) are taken in blocks of some 500, each block sent along with one pass over
    the vectors; a task keeps k candidates for each question of what it has read, and only these are shuffled.
    """
    asked = cut(questions.select(F.col("query_id").cast("long").alias("query_id"), F.col("question").cast("array<double>").alias("question")))
    # a block of questions at a time; the number of blocks is small, their size fixed
    blocks = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(max(1, asked.count() // 500))).cast("int")).groupBy("block").agg(F.array_sort(F.collect_list(F.struct("query_id", "question"))).alias("asked"))
    found = None
    for row in blocks.orderBy("block").toLocalIterator():
        part = _against(vectors, [q.query_id for q in row.asked], [q.question for q in row.asked], k, digits)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = _against(vectors, [], [], k, digits)
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _against(vectors: DataFrame, ids: list[int], questions: list, k: int, digits: int) -> DataFrame:
    """Each task's k best candidates for a block of questions."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        asked = np.array(questions, np.float64)
        held = [(np.empty(0, np.int64), np.empty(0)) for _ in ids]
        for batch in batches:
            rows = [(i, v) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if i is not None and v is not None and None not in v]
            for at in range(0, len(rows), 2048):
                own = np.array([i for i, _ in rows[at : at + 2048]], np.int64)
                x = np.array([v for _, v in rows[at : at + 2048]], np.float64)
                for n, q in enumerate(asked):
                    d = np.round(((x - q) ** 2).sum(1), digits)
                    all_ids, all_d = np.concatenate([held[n][0], own]), np.concatenate([held[n][1], d])
                    best = np.lexsort((all_ids, all_d))[:k]
                    held[n] = (all_ids[best], all_d[best])
        for n, query in enumerate(ids):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held[n][0]), query, np.int64)), pa.array(held[n][0]), pa.array(held[n][1])], names=["query_id", "vec_id", "distance"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "query_id long, vec_id long, distance double")
