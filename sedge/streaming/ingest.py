"""Incremental ingestion: a file stream whose batches are validated, then written graph first, vectors last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunks, elements, graph, index, vectors

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def latest(batch: DataFrame) -> DataFrame:
    """One row for each document of a batch: of several texts of an id the largest, whatever the order."""
    columns = [c for c in batch.columns if c != "doc_id"]
    return batch.groupBy("doc_id").agg(F.max(F.struct(*columns)).alias("v")).select("doc_id", "v.*").select(*batch.columns)


def store(docs: DataFrame, folder: str, number: int, encode=vectors.hashed_embedding) -> None:
    """Validates a batch and writes its tables: rejects, vertices, edges, elements, then chunks with vectors.

    A document with an element that breaks the schema is rejected as a whole.  Vectors come last, and the
    marker in ``done`` after them: a batch without it is written again, over what it left.
    """
    found = elements.structured(docs)
    bad = index.violations(found)
    bad.write.mode("overwrite").parquet(f"{folder}/rejects/batch={number}")
    bad = docs.sparkSession.read.parquet(f"{folder}/rejects/batch={number}").select("doc_id").distinct()
    good = found.join(bad, "doc_id", "left_anti")
    graph.vertices(good).write.mode("overwrite").partitionBy("tag").parquet(f"{folder}/vertices/batch={number}")
    graph.edges(good).write.mode("overwrite").parquet(f"{folder}/edges/batch={number}")
    good.write.mode("overwrite").parquet(f"{folder}/elements/batch={number}")
    blocks = chunks.build_blocks(good).select("doc_id", "block", "anchor", F.concat_ws("#", "anchor", "block").alias("chunk_id"), "text")
    told = blocks.withColumn("n", F.xxhash64("chunk_id"))
    encoded = encode(told, id_col="n").withColumnRenamed("doc_id", "n").dropDuplicates(["n"])
    told.join(encoded, "n").drop("n").write.mode("overwrite").parquet(f"{folder}/chunks/batch={number}")
    docs.agg(F.lit(number).alias("batch"), F.count("*").alias("documents")).write.mode("overwrite").parquet(f"{folder}/done/batch={number}")


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = SCHEMA, most_files: int | None = None):
    """Runs all files that have come since the last call through the engine; returns the finished query.

    A batch overwrites its own folders, so running it again after a failure changes nothing.
    """
    stream = spark.readStream.schema(schema)
    stream = stream.option("maxFilesPerTrigger", most_files) if most_files else stream
    write = lambda batch, number: store(latest(batch), target, number)
    query = stream.parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def status(spark: SparkSession, target: str) -> DataFrame:
    """(batch, documents, elements, chunks, rejects) of every finished batch."""
    n = lambda name: spark.read.parquet(f"{target}/{name}").groupBy("batch").agg(F.count("*").alias(name))
    done = spark.read.parquet(f"{target}/done").select("batch", "documents")
    for name in ("elements", "chunks", "rejects"):
        done = done.join(n(name), "batch", "left").fillna(0, [name])
    return done


def without(spark: SparkSession, target: str, name: str, docs: DataFrame) -> DataFrame:
    """A table of the store without the rows of some documents, to be written in its place."""
    return spark.read.parquet(f"{target}/{name}").join(docs.select("doc_id").distinct(), "doc_id", "left_anti")
