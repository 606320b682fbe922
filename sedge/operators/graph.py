"""The property graph of elements: vertices, edges, walks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .elements import caption_links, tag_of


def vertices(elements: DataFrame, preview: int = 2000) -> DataFrame:
    """A vertex for each id; elements that share an id are one, the smallest in all their properties."""
    return elements.select(F.col("id").alias("vid"), tag_of(F.col("label")).alias("tag"), "label", "page_no", F.substring("text", 1, preview).alias("text"), F.lit("").alias("minio_url"), "doc_id").groupBy("vid").agg(F.min(F.struct("doc_id", "page_no", "tag", "label", "text", "minio_url")).alias("v")).select("vid", "v.tag", "v.label", "v.page_no", "v.text", "v.minio_url", "v.doc_id")


def edges(elements: DataFrame) -> DataFrame:
    """(doc_id, src, dst, edge_type, sequence, relation)."""
    root = F.concat(F.lit("doc_"), F.col("key"))
    parent = elements.select("doc_id", F.when(F.col("reference_id") == "DOC", root).otherwise(F.col("reference_id")).alias("src"), F.col("id").alias("dst"), F.lit("PARENT_OF").alias("edge_type"), F.col("order").alias("sequence"), F.lit(None).cast("string").alias("relation"))
    linked = caption_links(elements).select("doc_id", "src", "dst", F.lit("LINKED_TO").alias("edge_type"), F.lit(None).cast("int").alias("sequence"), F.lit("describes").alias("relation"))
    return parent.unionByName(linked)


def steps(edges: DataFrame) -> DataFrame:
    """(doc_id, node, ancestor) of each PARENT_OF edge."""
    return edges.where("edge_type = 'PARENT_OF'").select("doc_id", F.col("dst").alias("node"), F.col("src").alias("ancestor")).distinct()


def ancestors(edges: DataFrame) -> DataFrame:
    """(doc_id, node, ancestor, hops) along PARENT_OF, all the way up.

    A level is one equi-join on (document, node), kept in the shared folder; the walk ends with the first
    level that is empty, so as many levels are built as the deepest chain has.  Chains must not be circular.
    """
    up = cut(steps(edges))
    found = now = up.withColumn("hops", F.lit(1))
    above = up.select("doc_id", F.col("node").alias("ancestor"), F.col("ancestor").alias("above"))
    while True:
        now = cut(now.join(above, ["doc_id", "ancestor"]).select("doc_id", "node", F.col("above").alias("ancestor"), (F.col("hops") + 1).alias("hops")))
        if not now.limit(1).count():
            return found
        found = found.unionByName(now)


def children(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """(doc_id, src, dst, tag, sequence): direct children with their tags."""
    return edges.where("edge_type = 'PARENT_OF'").join(vertices.select(F.col("vid").alias("dst"), "tag"), "dst").select("doc_id", "src", "dst", "tag", "sequence")


def matching(rows: DataFrame, **properties) -> DataFrame:
    """Rows whose properties have the values given; None stands for a missing one."""
    for name, value in properties.items():
        rows = rows.where(F.col(name).eqNullSafe(F.lit(value)))
    return rows


def node(vertices: DataFrame, vid: str) -> DataFrame:
    """The vertex of an id with its tag and properties."""
    return vertices.where(F.col("vid") == vid)


def skeleton(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """(doc_id, document, section): sections directly below their document."""
    return children(edges, vertices).where(F.startswith("src", F.lit("doc_")) & (F.col("tag") == "SectionHeader")).select("doc_id", F.col("src").alias("document"), F.col("dst").alias("section"))


def breadcrumbs(walks: DataFrame, vertices: DataFrame) -> DataFrame:
    """(doc_id, node, trail): the texts of the sections above a node, outermost first, from ``ancestors``."""
    named = walks.join(vertices.where("tag = 'SectionHeader'").select(F.col("vid").alias("ancestor"), "text"), "ancestor")
    steps_ = F.array_sort(F.collect_list(F.struct((-F.col("hops")).alias("at"), "text")))
    return named.groupBy("doc_id", "node").agg(F.array_join(F.transform(steps_, lambda s: s["text"]), " > ").alias("trail"))


def document_of(walks: DataFrame) -> DataFrame:
    """(doc_id, node, document): the root above each node, from ``ancestors``."""
    return walks.where(F.startswith("ancestor", F.lit("doc_"))).select("doc_id", "node", F.col("ancestor").alias("document"))


def section_images(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """(doc_id, section, images, captions): how many visuals a section has, and the captions linked to them."""
    found = children(edges, vertices).where(F.col("tag").isin("Picture", "Table")).select("doc_id", F.col("src").alias("section"), F.col("dst").alias("visual")).distinct()
    linked = edges.where("edge_type = 'LINKED_TO'").groupBy("doc_id", F.col("dst").alias("visual")).agg(F.count_distinct("src").alias("captions"))
    return found.join(linked, ["doc_id", "visual"], "left").groupBy("doc_id", "section").agg(F.count("*").alias("images"), F.coalesce(F.sum("captions"), F.lit(0)).alias("captions"))


def citation(collection, filename, section):
    """'collection > filename > section', blank parts left out."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.concat_ws(" > ", blank(collection), blank(filename), blank(section))
