"""The folder that driver and executors share, tables cut from their lineage, and key-range shards.

Intermediate tables and artefacts go below the folder named by ``spark.checkpoint.dir``.  Only a local
session may leave that unset (as tests do) and gets a folder on this machine; on a cluster that is an
error, as executors don't see one another's folders.  Tables that are read once more only are removed as
soon as the next one is written; ``release`` removes what results were still read from.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_FOLDERS: list[str] = []
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder: the session's ``spark.checkpoint.dir``; a local session may lack it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="sedge-"))
    return _LOCAL[0]


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a folder of its own for one run of an operator."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.append(folder)
    return folder


def removed(*folders: str) -> None:
    """Removes folders that nothing reads any more."""
    for folder in folders:
        fs, path = filesystem(folder)
        with contextlib.suppress(OSError):
            fs.delete_dir(path)


def release() -> None:
    """Removes every folder that operators have made in this process; results read from them end with it."""
    removed(*_FOLDERS)
    _FOLDERS.clear()


def written(df: DataFrame, folder: str) -> DataFrame:
    """The table written to the shared folder and read again: cuts the lineage and survives lost executors.

    Its shuffle files go once it is written, as nothing reads them any more.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(folder)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI, for artefacts that are not tables (file, hdfs, s3, gs)."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def text_batches(batches: Iterator, rows: int = 512) -> Iterator:
    """Record batches in slices of a few hundred rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same batches; what they took goes back to the system once a task is through.

    A Python worker serves many tasks, and without this each one keeps the most that any of them needed.
    """

    def through(batches: Iterator) -> Iterator:
        import ctypes
        import gc

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return through


# --- shards ---------------------------------------------------------------------------------------

LEAST_KEY, SUBS = -(1 << 63), 1 << 31
MOST_PARTITIONS = 20_000


def _halved(bounds: list[tuple[int, int]], key: Column, sub: Column) -> Column:
    """Number of the last bound that isn't above (key, sub), by halving a constant array."""
    constant = lambda k, kind: F.split(F.lit(",".join(str(b[k]) for b in bounds)), ",").cast(f"array<{kind}>")
    keys, subs, n = constant(0, "bigint"), constant(1, "int"), len(bounds)

    def step(acc, _):
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        reached = (F.get(keys, mid) < key) | (F.get(keys, mid) == key) & (F.get(subs, mid) <= sub)
        found = F.when(reached, F.struct(mid.alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi")))
        return F.when(acc["hi"] - acc["lo"] <= 1, acc).otherwise(found)

    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, n.bit_length()))), start, step, lambda acc: acc["lo"])


class Shards:
    """Ranges of (key, sub) that weigh about ``target`` each, sub being a hash of a row's content.

    Keys are weighed in steps whose width is a power of two; only steps over twice the target are weighed
    again, in 64 finer steps each, down to single keys, which are cut by sub evenly (null keys come first,
    as one key).  So a key that holds a third of all rows is many shards, and the bounds depend on the
    data alone, not on how Spark deals it out.  The driver sees 1,024 sums and 64 for each heavy step: a
    number in proportion to the shards, never rows.  A row's shard is found by halving a constant array.
    """

    def __init__(self, rows: DataFrame, key: str, weight: str, target: int):
        """``rows`` has the key (long) and the weight (long) and is read a few times: a narrow, written table."""
        k = F.coalesce(F.col(key), F.lit(LEAST_KEY).cast("long"))
        rows = rows.select(k.alias("k"), F.col(weight).cast("long").alias("w"))
        known = F.col("k") > LEAST_KEY
        ends = rows.agg(F.min(F.when(known, F.col("k"))).alias("lo"), F.max("k").alias("hi"), F.sum(F.when(~known, F.col("w"))).alias("null_weight")).first()
        self.bounds: list[tuple[int, int]] = []
        if ends.null_weight is not None:
            self._cut(LEAST_KEY, int(ends.null_weight), target)
        if ends.lo is not None:
            lo, hi, shift = int(ends.lo), int(ends.hi), 0
            while (hi >> shift) - (lo >> shift) >= 1024:
                shift += 1
            self._fill(rows.where(known), shift, target)
        self.bounds = self.bounds or [(LEAST_KEY, 0)]

    def _cut(self, key: int, weight: int, target: int) -> None:
        n = max(1, -(-weight // target))
        self.bounds += [(key, SUBS * i // n) for i in range(n)]

    def _fill(self, rows: DataFrame, shift: int, target: int) -> None:
        spark, weighed, heavy = rows.sparkSession, [], None
        while True:
            step = F.shiftright("k", shift)
            if heavy is not None:
                # at most half as many rows as there are shards
                within = F.broadcast(spark.createDataFrame([(x,) for x in heavy], "above long"))
                rows = rows.join(within, F.shiftright("k", before) == F.col("above"), "left_semi")
            found = [(int(r.at), int(r.w or 0)) for r in rows.groupBy(step.alias("at")).agg(F.sum("w").alias("w")).collect()]
            heavy = [at for at, w in found if w > 2 * target and shift]
            weighed += [(at << shift, w, shift) for at, w in found if w <= 2 * target or not shift]
            if not heavy:
                break
            before, shift = shift, max(0, shift - 6)
        held = None
        for at, w, width in sorted(weighed):
            if not width and w > 2 * target:
                self._cut(at, w, target)
                held = None
            elif held is None or held + w > target:
                self.bounds.append((at, 0))
                held = w
            else:
                held += w

    def __len__(self) -> int:
        return len(self.bounds)

    def of(self, key: Column, sub: Column) -> Column:
        """Number of a row's shard."""
        return _halved(self.bounds, F.coalesce(key, F.lit(LEAST_KEY).cast("long")), sub).cast("int")

    def dealt(self, df: DataFrame, shard: str = "shard") -> DataFrame:
        """A partition for each shard; beyond ``MOST_PARTITIONS`` for as many neighbouring ones as needed."""
        n = min(len(self), MOST_PARTITIONS)
        return df.repartitionById(n, F.floor(F.col(shard).cast("long") * n / len(self)).cast("int"))
