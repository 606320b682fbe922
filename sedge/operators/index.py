"""The vector index: chunks with their metadata, vectors, keyed writes, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_content, stripped
from .chunks import anchored, chunk_id, contextualized

#: Metadata keys of a chunk, in order, with their types.
METADATA = {
    "element_id": "string", "graph_node_id": "string", "filename": "string", "collection": "string", "source_path": "string", "language": "string", "label": "string", "page_no": "int", "minio_url": "string",
    "reference_id": "string", "depth": "int", "section_title": "string", "page_position": "int", "ref_position": "int", "chunk_index": "int", "chunk_count": "int", "block_size": "int",
}
FLOOR = 24
ID = r"^[a-f0-9]{10}$"


def build_chunks(rows: DataFrame, documents: DataFrame, floor: int = FLOOR) -> DataFrame:
    """(chunk_id, document, *METADATA) of the pieces that are kept.

    ``rows`` has the elements with self_ref and the pieces' references with text, as ``anchored`` takes them,
    ``documents`` (doc_id, filename, collection, source_path, language).  Pieces without a known reference go;
    anchors are numbered before those without content or below ``floor`` characters go, so that numbers may
    have gaps.  If ``rows`` are divided by document, texts are not shuffled here.
    """
    own = ("label", "page_no", "reference_id", "depth", "section_title", "page_position", "ref_position")
    met = anchored(rows, own, texts=True).withColumn("document", stripped(F.col("text"))).join(documents, "doc_id")
    kept = met.where(has_content(F.col("document")) & (F.length("document") >= floor))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int")
    told = {
        "element_id": F.col("id"), "graph_node_id": F.col("id"), "filename": text("filename"), "collection": text("collection"), "source_path": text("source_path"), "language": text("language"), "label": text("label"),
        "page_no": number("page_no"), "minio_url": F.lit(""), "reference_id": F.coalesce("reference_id", F.lit("DOC")), "depth": number("depth"), "section_title": text("section_title"),
        "page_position": number("page_position"), "ref_position": number("ref_position"), "chunk_index": number("chunk_index"), "chunk_count": number("chunk_count"), "block_size": number("block_size"),
    }
    return kept.select(chunk_id(F.col("id"), F.col("chunk_index"), F.col("chunk_count")).alias("chunk_id"), "document", *[told[k].alias(k) for k in METADATA])


def embedding_text(chunks: DataFrame, with_title: bool = True) -> Column:
    """What is embedded: the stored text, with its section's title in front if wanted."""
    return contextualized(F.col("document"), F.col("section_title")) if with_title else F.col("document")


def upserted(old: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """All rows of ``new`` (of one key the largest) and those of ``old`` whose key it lacks.

    A new row replaces an old one; nothing depends on the order in which rows come.
    """
    columns = [c for c in new.columns if c != key]
    last = new.groupBy(key).agg(F.max(F.struct(*columns)).alias("v")).select(key, "v.*")
    return last.unionByName(old.join(last.select(key), key, "left_anti").select(*last.columns))


def violations(elements: DataFrame) -> DataFrame:
    """(doc_id, id, reason) of elements that break the schema; none if all may be written."""
    tests = {
        "id is missing": F.coalesce(F.col("id"), F.lit("")) == "",
        "label is missing": F.coalesce(F.col("label"), F.lit("")) == "",
        "page is below 1": F.coalesce(F.col("page_no"), F.lit(1)) < 1,
        "order is missing or negative": F.coalesce(F.col("order"), F.lit(-1)) < 0,
        "depth is negative": F.coalesce(F.col("depth"), F.lit(0)) < 0,
    }
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    return elements.select("doc_id", "id", F.explode(reasons).alias("reason"))


def contract(chunks: DataFrame, vertices: DataFrame) -> DataFrame:
    """One row: chunks, malformed, diverging and repeated ids, ids with a number, anchors that the graph lacks."""
    known = vertices.select(F.col("vid").alias("element_id"), F.lit(True).alias("known")).distinct()
    met = chunks.join(known, "element_id", "left")
    ids = F.coalesce("element_id", F.lit(""))
    return met.agg(
        F.count("*").alias("chunks"),
        F.count_if(~ids.rlike(ID)).alias("malformed"),
        F.count_if(~F.col("element_id").eqNullSafe(F.col("graph_node_id"))).alias("diverging"),
        (F.count("chunk_id") - F.count_distinct("chunk_id")).alias("repeated"),
        F.count_if(F.col("chunk_id").contains("#")).alias("numbered"),
        F.count_distinct(F.when(F.col("known").isNull(), F.col("element_id"))).alias("dangling"),
    )


def nodes_of(chunks: DataFrame, vertices: DataFrame) -> DataFrame:
    """(chunk_id, vid, tag, page_no): the vertex each chunk of a search leads to; chunks without one are left out."""
    return chunks.select("chunk_id", F.col("graph_node_id").alias("vid")).join(vertices.select("vid", "tag", "page_no"), "vid").select("chunk_id", "vid", "tag", "page_no")


def missing_keys(chunks: DataFrame) -> list[str]:
    """Metadata keys that a table of chunks lacks."""
    return [k for k in METADATA if k not in chunks.columns]


def block_sizes(chunks: DataFrame) -> DataFrame:
    """One row: median and largest number of elements of a chunk (none or 0 counts as 1)."""
    n = F.coalesce(F.nullif(F.col("block_size"), F.lit(0)), F.lit(1))
    return chunks.agg(F.median(n).alias("median_size"), F.max(n).cast("long").alias("largest"), F.count_if(n > 1).alias("fused"))


def window_overflow(chunks: DataFrame, window: int = 128, tokens: Column | None = None) -> DataFrame:
    """One row: chunks over the encoder's window, median and largest count; tokens are words unless given."""
    n = F.size(F.filter(F.split(embedding_text(chunks), r"\s+"), lambda w: w != "")) if tokens is None else tokens
    return chunks.select(n.alias("n")).agg(F.count_if(F.col("n") > window).alias("over"), F.median("n").alias("median_tokens"), F.max("n").cast("long").alias("largest"))


def reranked(found: DataFrame, score: Column, k: int = 10, by: str = "query_id", key: str = "doc_id") -> DataFrame:
    """(by, key, score, rank) of the k best of each query; ``score`` is any column, a model's or that of words."""
    order = Window.partitionBy(by).orderBy(F.col("score").desc(), key)
    return found.select(by, key, score.alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lexical(question: Column, text: Column) -> Column:
    """Share of a question's distinct words that a text has."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    asked = words(question)
    return F.when(F.size(asked) > 0, F.size(F.array_intersect(asked, words(text))) / F.size(asked)).otherwise(F.lit(0.0))
