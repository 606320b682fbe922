"""Sharded files written by tasks: temporary names, a manifest, then a rename that can be repeated.

A task writes files below ``_staging`` under names of its own attempt and returns a manifest row for
each.  Spark's own output commit keeps the rows of one attempt of each task; only the files that these
rows name are renamed, by tasks again, and the final manifest is what readers go by.  A lost executor
costs its tasks, never a file twice or half a file.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import MOST_PARTITIONS, filesystem, lean

MANIFEST = "shard int, part int, staged string, file string, n_records long, n_units long, n_bytes long, sha256 string"


class Output:
    """One file being written below a folder, hashed as it goes."""

    def __init__(self, folder: str, name: str, attempt: str):
        import hashlib

        self.fs, top = filesystem(folder)
        self.staged, self.file = f"_staging/{name}.{attempt}", name
        self.fs.create_dir(f"{top}/_staging", recursive=True)
        self.out = self.fs.open_output_stream(f"{top}/{self.staged}", compression=None)
        self.hash, self.n_bytes, self.n_records, self.n_units = hashlib.sha256(), 0, 0, 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.n_bytes += len(data)

    def close(self, shard: int, part: int) -> dict:
        self.out.close()
        return {"shard": shard, "part": part, "staged": self.staged, "file": self.file, "n_records": self.n_records, "n_units": self.n_units, "n_bytes": self.n_bytes, "sha256": self.hash.hexdigest()}


def attempt_name() -> str:
    """A name that no other attempt of any task has."""
    import uuid

    return uuid.uuid4().hex


def manifest_batch(rows: list[dict]):
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    fields = [f.split(" ") for f in MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def publish(rows: DataFrame, write: Callable[[Iterator], Iterator], folder: str) -> DataFrame:
    """Runs the writing tasks over ``rows`` and returns the committed manifest."""
    spark = rows.sparkSession
    staged = f"{folder}/_staging_manifest"
    rows.mapInArrow(write, MANIFEST).write.parquet(staged)

    def rename(batches: Iterator) -> Iterator:
        fs, top = filesystem(folder)
        for batch in batches:
            for r in batch.to_pylist():
                source, target = f"{top}/{r['staged']}", f"{top}/{r['file']}"
                try:
                    fs.move(source, target)
                except OSError:  # an earlier attempt of this task has renamed it
                    if fs.get_file_info(target).size != r["n_bytes"]:
                        raise
            yield batch

    found = spark.read.schema(MANIFEST).parquet(staged)
    found.mapInArrow(rename, MANIFEST).write.parquet(f"{folder}/manifest")
    fs, top = filesystem(folder)
    for leftover in ("_staging", "_staging_manifest"):
        with contextlib.suppress(OSError):
            fs.delete_dir(f"{top}/{leftover}")
    return manifest(spark, folder)


def manifest(spark, folder: str) -> DataFrame:
    """The committed files of a folder."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def each_file(files: DataFrame, read: Callable[[str, dict], Iterator], folder: str, schema: str) -> DataFrame:
    """``read(uri, manifest row)``'s record batches for every committed file, one task for a few files."""
    n = min(max(1, files.count()), MOST_PARTITIONS)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for r in batch.to_pylist():
                yield from read(f"{folder}/{r['file']}", r)

    return files.repartitionByRange(n, F.col("shard"), F.col("part")).mapInArrow(lean(run), schema)
