"""File discovery: recursive scan, change detection against a manifest, exact duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: File suffixes and the type they are read as.
TYPES = {".pdf": "pdf", ".html": "html", ".htm": "html", ".md": "md", ".markdown": "md"}


def discover(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, modified, length, content, type); unknown suffixes have a null type."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    suffix = F.lower(F.regexp_extract("path", r"\.[^./]+$", 0))
    kinds = F.create_map(*[F.lit(x) for p in TYPES.items() for x in p])
    return found.select("path", F.col("modificationTime").alias("modified"), "length", "content", F.element_at(kinds, suffix).alias("type"))


def kind_of(path: Column) -> Column:
    """The type a file is read as, by its suffix; an unknown suffix is an error, as in the readers."""
    suffix = F.lower(F.regexp_extract(path, r"\.[^./\\]+$", 0))
    known = F.element_at(F.create_map(*[F.lit(x) for p in TYPES.items() for x in p]), suffix)
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unsupported format: "), path)).cast("string"))


def source_path(path: Column, root: str = "Datas") -> Column:
    """The part of a path after its first folder named ``root``; without one, the file's name."""
    after = F.regexp_extract(path, rf"(?:^|/){root}/(.*)$", 1)
    return F.when(after != "", after).otherwise(F.substring_index(path, "/", -1))


def changed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest lacks or has an older version of; both have (partition_key, modified)."""
    known = manifest.groupBy("partition_key").agg(F.max("modified").alias("__seen"))
    return files.join(known, "partition_key", "left").where("__seen is null or __seen < modified").drop("__seen")


def duplicates(files: DataFrame, key: str = "doc_id", digest: str = "content_hash") -> DataFrame:
    """Adds duplicate_of: the smallest other key of the same digest that comes before (blank digests: none).

    Keys are aggregated by digest before anything is shuffled, so a very common digest is one row a task.
    """
    first = files.where(F.col(digest) != "").groupBy(digest).agg(F.min(key).alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    return files.join(first, digest, "left").withColumn("duplicate_of", F.when(F.col("__first") < F.col(key), F.col("__first"))).drop("__first")
