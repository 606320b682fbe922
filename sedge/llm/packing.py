"""Harmonic packing of documents into fixed-length training sequences.

Lengths are partitioned into reciprocal-capacity classes: class k takes pieces of at most
``capacity // k`` tokens, and each of its sequences takes exactly k of them, so that a piece's sequence
follows from its rank within its class alone.  A document longer than a slot is cut so that its pieces
fill slots exactly; a rest that nearly fills a slot (a 32nd, at most, left over) stays whole.  Tasks
number the pieces of each class on their own; one small sum over (task, class) counts turns these
numbers into ranks, and no task ever holds a class.  What is left of each class after its last full
sequence (fewer than k pieces, some 20,000 in all whatever the input) is packed by best fit.

Defined cases: a null text counts as empty and has the end id alone; a null id is passed through;
repeated rows are packed each; an empty table gives no sequences; other columns are left out, so their
names can't clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import lean, new_folder, text_batches, written
from .word_ids import word_ids

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k int, task int, number long"


def pieces_of(n: int, capacity: int, slack: int = 32) -> list[tuple[int, int]]:
    """(length, class) of the pieces that n tokens are cut into, in order."""
    found = []
    while n > 0:
        if n >= capacity:
            found.append((capacity, 1))
            n -= capacity
            continue
        k = capacity // n
        slot = capacity // k
        if (slot - n) * slack <= slot:
            found.append((n, k))
            break
        slot = capacity // (k + 1)
        found.append((slot, capacity // slot))
        n -= slot
    return found


def _cut(df: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode, task, numbers = word_ids(tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in text_batches(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                total, at = len(ids) // 4, 0
                for length, k in pieces_of(total, capacity):
                    rows.append((doc, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)]), total, k, task, numbers[k]))
                    numbers[k] += 1
                    at += length
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64()]
            names = [f.split(" ")[0] for f in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return df.mapInArrow(lean(run), PIECES)


def _best_fit(first: int, capacity: int):
    """Packs the pieces of one small table, longest first, each into the fullest sequence with room."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "k", "rank"], ascending=[False, True, True], kind="stable")
        room: list[tuple[int, int]] = []
        used: list[int] = []
        sequence, offset = [], []
        for n in rows["length"]:
            i = bisect_left(room, (n, -1))
            left, s = room.pop(i) if i < len(room) else (capacity, len(used))
            if s == len(used):
                used.append(0)
            sequence.append(first + s)
            offset.append(used[s])
            used[s] += n
            if left > n:
                insort(room, (left - n, s))
        return rows.assign(sequence_id=sequence, offset=offset)[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return run


def pack(df: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Returns (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset); sequences are numbered
    from 0 without gaps.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "packing")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(_cut(rows, tokenizer, capacity, end_id), f"{folder}/pieces")

    counts = pieces.groupBy("k", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("k").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), f"{folder}/counts")
    # at most one row for each class: some 130 for 4096
    totals = {r.k: r.n for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    base, full = {}, 0
    for k in sorted(totals):
        base[k] = full
        full += totals[k] // k

    # one row for each class, as a literal table
    classes = spark.createDataFrame([(k, base[k], totals[k] // k * k) for k in sorted(totals)], "k int, first long, whole long")
    ranked = (
        pieces.join(counts.drop("n"), ["k", "task"])
        .join(F.broadcast(classes), "k")
        .withColumn("rank", F.col("before") + F.col("number"))
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    running = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        ranked.where("rank < whole")
        .withColumn("sequence_id", (F.col("first") + F.floor(F.col("rank") / F.col("k"))).cast("long"))
        .withColumn("offset", F.coalesce(F.sum("length").over(running), F.lit(0)).cast("long"))
        .select(*columns, "sequence_id", "offset")
    )
    rest = ranked.where("rank >= whole").select(*columns, "k", "rank", F.lit(0).alias("rest")).groupBy("rest").applyInPandas(_best_fit(full, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return filled.unionByName(rest)
