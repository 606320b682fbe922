"""Jobs: the times of a queue that one worker serves, failures, pages left out, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def served(jobs: DataFrame, by: str = "queue", at: str = "at", lasts: str = "lasts", order: str = "job_id", block: int = 3_600_000) -> DataFrame:
    """Adds begins and ends (in ``at``'s unit, whole numbers) of jobs that one worker a queue runs in order of arrival.

    A job ends at the sum of all times up to its own, later by the longest wait there was before: for each
    job its arrival less the times before it, at most.  Both are found within blocks of arrival times and
    carried on between blocks, so that a queue of any length is sorted in parts and only a row a block of it is not.
    """
    cut = jobs.withColumn("__b", F.floor(F.col(at) / block))
    within = Window.partitionBy(by, "__b").orderBy(at, order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("__s", F.sum(lasts).over(within)).withColumn("__m", F.max(F.col(at) - F.col("__s") + F.col(lasts)).over(within))
    blocks = local.groupBy(by, "__b").agg(F.sum(lasts).alias("__all"), F.max("__m").alias("__most"))
    before = Window.partitionBy(by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__p", F.coalesce(F.sum("__all").over(before), F.lit(0))).withColumn("__h", F.max(F.col("__most") - F.col("__p")).over(before))
    ends = F.col("__p") + F.col("__s") + F.greatest(F.col("__m") - F.col("__p"), F.col("__h"))
    found = local.join(blocks.select(by, "__b", "__p", "__h"), [by, "__b"]).withColumn("ends", ends)
    return found.withColumn("begins", F.col("ends") - F.col(lasts)).select(*jobs.columns, "begins", "ends")


def failure(kind: Column, message: Column) -> Column:
    """'Type: message' as a failed job's status gives it."""
    return F.concat(kind, F.lit(": "), F.coalesce(message, F.lit("")))


def left_out(expected: DataFrame, found: DataFrame, by: str = "doc_id", page: str = "page_no") -> DataFrame:
    """(doc_id, missing, pages): how many expected pages of a document weren't read, and which, in order."""
    gone = expected.select(by, page).distinct().join(found.select(by, page), [by, page], "left_anti")
    return gone.groupBy(by).agg(F.count("*").alias("missing"), F.array_join(F.array_sort(F.collect_list(page)), ", ").alias("pages"))


def progress(elements: DataFrame, chunks: DataFrame, by: str = "doc_id") -> DataFrame:
    """(doc_id, elements, pages, chunks) of every document with elements."""
    told = elements.groupBy(by).agg(F.count("*").alias("elements"), F.max("page_no").alias("pages"))
    return told.join(chunks.groupBy(by).agg(F.count("*").alias("chunks")), by, "left").fillna(0, ["chunks"])
