"""Token-id archive: one zstandard frame for each document under a shared dictionary.

The dictionary is trained on serialized id arrays of a bounded sample (``sample_docs`` documents, the
first ``sample_bytes`` bytes of each; only compression depends on it).  A shard file holds, in this order:

* 8 bytes ``SDGTOK1`` and a zero byte, the dictionary's SHA-256 (32 bytes), bytes an id (1 byte);
* the documents' frames, in ascending id order;
* the offset index: arrays of has-id (u1), id (i8), frame offset (u8), frame length (u4), ids (u8);
* the index's offset (u8) and the number of documents (u8).

A single short document is one index lookup and one small frame (``lookup``).

Shards hold about ``shard_bytes`` of text each, and a task writes each; an id (or null) that holds more than
a shard is cut by a hash of the text.

Defined cases: a null text counts as empty and has the end id alone; null ids come first; rows with
equal ids are ordered by a hash of their text, then by their frames; an empty table gives an archive of no
files; other columns are left out, so their names can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .archive import Output, attempt_name, each_file, manifest, manifest_batch, publish
from .storage import Shards, filesystem, lean, new_folder, removed, text_batches, written
from .word_ids import word_ids

MAGIC = b"SDGTOK1\0"
DOCS = "doc_id long, start long, n_tokens long, ids binary"


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """The trained dictionary; with too few samples for training, their plain content."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _with(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_AUTO) if raw else None


@lru_cache(maxsize=4)
def _reader(folder: str, digest: str):
    import hashlib

    import zstandard

    fs, top = filesystem(folder)
    with fs.open_input_stream(f"{top}/dictionary-{digest}") as file:
        raw = file.read()
    if hashlib.sha256(raw).hexdigest() != digest:
        raise ValueError("the dictionary is not the one the archive was written with")
    return zstandard.ZstdDecompressor(dict_data=_with(raw))


def write_token_archive(df: DataFrame, folder: str, tokenizer: str, end_id: int = 1, shard_bytes: int = 64 << 20, sample_docs: int = 2_000, sample_bytes: int = 8_192, dictionary_bytes: int = 65_536, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every whole text and writes the archive; returns its manifest.

    Only compressed frames are shuffled, once, by deterministic ranges of the id.
    """
    import hashlib

    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    folder_ = new_folder(spark, "tokens")
    narrow = written(rows.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 32).cast("long").alias("weight")), f"{folder_}/narrow")
    total = narrow.count()

    def serialized(text: str | None, width: int) -> tuple[int, bytes]:
        ids = np.frombuffer(word_ids(tokenizer)(text or "") + int(end_id).to_bytes(4, "little"), "<u4")
        return len(ids), ids.astype("<u2").tobytes() if width == 2 else ids.tobytes()

    width = 2 if word_ids(tokenizer).whole.get_vocab_size() <= 65_536 and end_id < 65_536 else 4

    def sampled(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in text_batches(batches):
            yield pa.RecordBatch.from_arrays([pa.array([serialized(t, width)[1][:sample_bytes] for t in batch.column(0).to_pylist()], pa.binary())], names=["ids"])

    share = min(1.0, 1.5 * sample_docs / max(1, total))
    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text").limit(sample_docs)
    raw = _dictionary(sorted(r.ids for r in some.mapInArrow(lean(sampled), "ids binary").collect()), dictionary_bytes)
    digest = hashlib.sha256(raw).hexdigest()
    fs, top = filesystem(folder)
    fs.create_dir(top, recursive=True)
    with fs.open_output_stream(f"{top}/dictionary-{digest}") as file:
        file.write(raw)

    shards = Shards(narrow, "doc_id", "weight", shard_bytes)

    def compress(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        codec = zstandard.ZstdCompressor(level=3, dict_data=_with(raw), write_checksum=False)
        for batch in text_batches(batches):
            got = [serialized(t, width) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([n for n, _ in got], pa.int64()), pa.array([codec.compress(b) for _, b in got], pa.binary())],
                names=["shard", "doc_id", "sub", "n_tokens", "frame"],
            )

    def write(batches: Iterator) -> Iterator:
        def ended(out: Output, index: list[tuple], shard: int) -> dict:
            at = out.n_bytes
            for k, kind in enumerate(("u1", "<i8", "<u8", "<u4", "<u8")):
                out.write(np.array([x[k] for x in index], kind).tobytes())
            out.write(np.array([at, len(index)], "<u8").tobytes())
            return out.close(shard, 0)

        out, index, shard, attempt = None, [], None, attempt_name()
        for batch in batches:
            for s, i, n, frame in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4)), strict=True):
                if s != shard:
                    if out:
                        yield manifest_batch([ended(out, index, shard)])
                    out, index, shard = Output(folder, f"tokens-{s:08d}", attempt), [], s
                    out.write(MAGIC + bytes.fromhex(digest) + bytes([width]))
                index.append((i is not None, i or 0, out.n_bytes, len(frame), n))
                out.write(frame)
                out.n_records += 1
                out.n_units += n
        if out:
            yield manifest_batch([ended(out, index, shard)])

    sub = F.pmod(F.xxhash64("text"), F.lit(1 << 31)).cast("int")
    placed = rows.select(shards.of(F.col("doc_id"), sub).alias("shard"), "doc_id", sub.alias("sub"), "text")
    frames = placed.mapInArrow(lean(compress), "shard int, doc_id long, sub int, n_tokens long, frame binary")
    dealt = shards.dealt(frames).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "sub", "n_tokens", "frame")
    done = publish(dealt, lean(write), folder)
    removed(folder_)
    return done


def _opened(uri: str):
    """(file, dictionary hash, id width, index arrays) of a shard file."""
    fs, path = filesystem(uri)
    file = fs.open_input_file(path)
    head = file.read(len(MAGIC) + 33)
    if head[: len(MAGIC)] != MAGIC:
        raise ValueError(f"{uri} is not a token archive")
    size = file.size()
    file.seek(size - 16)
    at, n = (int(x) for x in np.frombuffer(file.read(16), "<u8"))
    file.seek(at)
    index, raw, pos = [], file.read(size - 16 - at), 0
    for kind in ("u1", "<i8", "<u8", "<u4", "<u8"):
        index.append(np.frombuffer(raw, kind, n, pos))
        pos += n * np.dtype(kind).itemsize
    return file, head[len(MAGIC) : -1].hex(), head[-1], index


def lookup(uri: str, doc_id: int) -> np.ndarray | None:
    """The ids of one document: a search of the index and one frame."""
    file, digest, width, (has, ids, offsets, lengths, _) = _opened(uri)
    with file:
        first = int(np.count_nonzero(has == 0))
        k = first + int(np.searchsorted(ids[first:], doc_id))
        if k >= len(ids) or ids[k] != doc_id:
            return None
        file.seek(int(offsets[k]))
        return np.frombuffer(_reader(uri.rpartition("/")[0], digest).decompress(file.read(int(lengths[k]))), f"<u{width}").astype("<u4")


def _read_with(emit, schema: str, spark: SparkSession, folder: str) -> DataFrame:
    files = manifest(spark, folder)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = files.withColumn("before", F.coalesce(F.sum("n_units").over(before), F.lit(0)))

    def read(uri: str, row: dict) -> Iterator:
        import pyarrow as pa

        file, digest, width, (has, ids, offsets, lengths, counts) = _opened(uri)
        codec, starts = _reader(folder, digest), row["before"] + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("i8")
        with file:
            file.seek(len(MAGIC) + 33)
            for at in range(0, len(ids), 1024):
                part = slice(at, at + 1024)
                payload = [np.frombuffer(codec.decompress(file.read(int(n))), f"<u{width}").astype("<u4").tobytes() for n in lengths[part]]
                if [len(p) // 4 for p in payload] != counts[part].tolist():
                    raise ValueError(f"{uri} is damaged")
                yield pa.RecordBatch.from_arrays([pa.array(ids[part], pa.int64(), mask=has[part] == 0), pa.array(starts[part]), pa.array(counts[part].astype("i8")), emit(payload)], names=["doc_id", "start", "n_tokens", schema.split(" ")[0]])

    return each_file(files, read, folder, f"doc_id long, start long, n_tokens long, {schema}")


def read_token_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, ids as little-endian unsigned 32-bit bytes."""

    def emit(payload):
        import pyarrow as pa

        return pa.array(payload, pa.binary())

    return _read_with(emit, "ids binary", spark, folder)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document read back from the archive."""

    def emit(payload):
        import pyarrow as pa

        return pa.array([zlib.crc32(p) for p in payload], pa.int64())

    return _read_with(emit, "ids_crc32 long", spark, folder)
