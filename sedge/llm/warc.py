"""Deterministic sharded WARC writer and reader.

Records are range-sorted by page id into shards of about ``shard_bytes`` of payload whose bounds depend on
the data alone, a task for each; each shard rolls to a new file once its compressed size passes the limit,
headers and digests are made anew from the payload, and files appear under their names only through a
committed manifest (``archive``).  A page id (or null) that holds more than a shard is cut by digest.  Of the
records with equal payloads of at least ``least`` bytes the one with the smallest id holds the payload;
the others are revisit records that name it.  Running the writer again gives the same bytes.

Roles travel as narrow rows: payload digests are aggregated before anything is shuffled, only digests
that occur twice meet the pages again (salted, as one digest may have a third of all pages), and each
role row is sorted in front of its page.  Payloads are shuffled once, to their shard.

Defined cases: a null payload counts as empty; a null page id comes first and is never referred to
while a page with an id has the payload; a page id that occurs twice with one payload is a response
once, then a revisit of itself (at ``least`` bytes or more), and all its rows with that payload lie in one
shard; a null url becomes a URN of the page id; an empty table gives an archive of no files; other columns
are left out, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archive import Output, attempt_name, each_file, manifest, manifest_batch, publish
from .storage import Shards, filesystem, lean, new_folder, removed, text_batches, written

#: Fixed values of the WARC format.
VERSION, REVISIT = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

SALTS = 16
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string, offset long, payload binary"


def _member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _block(headers: list[tuple[str, str]], body: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(body)))])
    return f"{VERSION}\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def _urn(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}:{digest[:16]}" + (f":{copy}" if copy else "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, copy: int, date: str) -> bytes:
    """One record as bytes: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    target = " ".join((url or f"urn:x-page:{'' if page_id is None else page_id}").split())
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{_urn(page_id, digest, copy)}>"), ("WARC-Date", date), ("WARC-Target-URI", target)]
    if revisit:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<{_urn(refers_to, digest)}>")]
    headers += [("Content-Type", HTTP_TYPE), ("WARC-Block-Digest", "sha256:" + hashlib.sha256(body).hexdigest()), ("WARC-Payload-Digest", f"sha256:{digest}")]
    return _block(headers, body)


def write_warc(df: DataFrame, folder: str, shard_bytes: int = 64 << 20, max_file_bytes: int = 256 << 20, least: int = 100, date: str = "2000-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes the archive and returns its manifest."""
    spark = df.sparkSession
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    folder_ = new_folder(spark, "warc")
    narrow = written(pages.select("page_id", F.sha2(F.encode("payload", "UTF-8"), 256).alias("digest"), F.octet_length("payload").cast("long").alias("n")), f"{folder_}/narrow")
    shards = Shards(narrow.select("page_id", (F.col("n") + 512).alias("weight")), "page_id", "weight", shard_bytes)
    large = narrow.where(F.col("n") >= least).select("page_id", "digest")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    salted = written(firsts, f"{folder_}/digests").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    roles = large.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"]).where("page_id is null or page_id > first").select("page_id", "digest", "first").distinct()

    sub = F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(1 << 31)).cast("int")
    shard = shards.of(F.col("page_id"), sub).alias("shard")
    none = F.lit(None).cast("string")
    role_rows = roles.select(shard, "page_id", F.lit(0).alias("kind"), "digest", "first", none.alias("url"), none.alias("payload"))
    hashed = pages.withColumn("digest", F.sha2(F.encode("payload", "UTF-8"), 256))
    page_rows = hashed.select(shard, "page_id", F.lit(1).alias("kind"), "digest", F.lit(None).cast("long").alias("first"), "url", "payload")
    dealt = shards.dealt(role_rows.unionByName(page_rows)).sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "digest", "kind", F.col("url").asc_nulls_first())

    def write(batches: Iterator) -> Iterator:
        out, shard, part, attempt = None, None, 0, attempt_name()
        role, before, copy = None, None, 0
        for batch in text_batches(batches, 128):
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    role = (r["page_id"], r["digest"], r["first"])
                    continue
                if out is not None and (r["shard"] != shard or out.n_bytes > max_file_bytes):
                    yield manifest_batch([out.close(shard, part)])
                    part, out = (part + 1 if r["shard"] == shard else 0), None
                if out is None:
                    shard = r["shard"]
                    out = Output(folder, f"pages-{shard:08d}-{part:05d}.warc.gz", attempt)
                    info = f"software: sedge\r\nformat: {VERSION}\r\n".encode()
                    out.write(_member(_block([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{out.file}>"), ("WARC-Date", date), ("WARC-Filename", out.file), ("Content-Type", "application/warc-fields")], info)))
                page, digest, payload = r["page_id"], r["digest"], r["payload"].encode()
                copy = copy + 1 if before == (page, digest) else 0  # rows of one page and payload follow one another
                before = (page, digest)
                first = role[2] if role and role[:2] == before else page if page is not None and len(payload) >= least and copy else None
                out.write(_member(record(page, r["url"], payload, digest, first, first is not None, copy, date)))
                out.n_records += 1
                out.n_units += len(payload)
        if out is not None:
            yield manifest_batch([out.close(shard, part)])

    done = publish(dealt, lean(write), folder)
    removed(folder_)
    return done


def _records(file) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of every record of an open, unzipped archive."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := file.readline()).strip():
            k, _, v = line.decode().partition(":")
            headers[k.lower()] = v.strip()
        yield headers, file.read(int(headers["content-length"]))


def _page(urn: str) -> int | None:
    part = urn.strip("<>").split(":")[2]
    return int(part) if part else None


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the committed files; digests of payloads that are held are checked.

    Returns (page_id, payload_bytes, payload_digest, record_type, refers_to, url, file, offset, payload),
    with the payload of responses if asked for.  Bytes and digest of a revisit are those of the full
    payload, from its headers.
    """
    kinds = [f.split(" ") for f in RECORDS.split(", ")]

    def read(uri: str, row: dict) -> Iterator:
        import gzip

        import pyarrow as pa

        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])
        fs, path = filesystem(uri)
        rows, held = [], 0
        with fs.open_input_stream(path, compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw)) as file:
            number = 0
            for headers, block in _records(file):
                if headers["warc-type"] == "warcinfo":
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                digest, kind = headers["warc-payload-digest"].removeprefix("sha256:"), headers["warc-type"]
                if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"{uri} is damaged at {headers['warc-record-id']}")
                rows.append((_page(headers["warc-record-id"]), size, digest, kind, _page(headers["warc-refers-to"]) if kind == "revisit" else None, headers["warc-target-uri"], row["file"], number, payload if payloads and kind == "response" else None))
                number += 1
                held += len(payload) if payloads else 0
                if len(rows) >= 1024 or held > 16 << 20:
                    yield batch(rows)
                    rows, held = [], 0
        if number != row["n_records"]:
            raise ValueError(f"{uri} holds {number} records, its manifest {row['n_records']}")
        if rows:
            yield batch(rows)

    return each_file(manifest(spark, folder), read, folder, RECORDS)
