"""Reports: retention of runs, percentages, checks of the index against the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def retained(runs: DataFrame, most: int = 500) -> DataFrame:
    """Runs (event_id, queue, s) that are kept: a queue's newest ``most``, and all from its oldest open one on.

    Only the newest ``most`` rows of each queue and task are shuffled, and one bound comes back for each queue.
    """
    newest = runs.withColumn("__r", F.row_number().over(Window.partitionBy("queue").orderBy(F.col("event_id").desc()))).where(F.col("__r") <= most)
    bound = newest.groupBy("queue").agg(F.min("event_id").alias("__new"))
    open_ = runs.where(F.col("s").isin("pending", "running")).groupBy("queue").agg(F.min("event_id").alias("__open"))
    since = bound.join(open_, "queue", "left").select("queue", F.least("__new", "__open").alias("__since"))
    return runs.join(since, "queue").where(F.col("event_id") >= F.col("__since")).drop("__since")


def percentage(part: Column, whole: Column) -> Column:
    """'12.3 %', or a dash where there is nothing to divide by."""
    return F.when(whole > 0, F.concat(F.round(100.0 * part / whole, 1).cast("decimal(12,1)").cast("string"), F.lit(" %"))).otherwise("\u2014")


def dangling(ids: DataFrame, vertices: DataFrame) -> DataFrame:
    """Ids (element_id) of the index that the graph lacks; all of them, not a sample."""
    return ids.select("element_id").distinct().join(vertices.select(F.col("vid").alias("element_id")), "element_id", "left_anti")


def missing_keys(rows: DataFrame, expected: list[str]) -> list[str]:
    """Expected columns that a table lacks."""
    return sorted(set(expected) - set(rows.columns))
