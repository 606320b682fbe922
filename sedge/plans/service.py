"""Queries on jobs, and what follows a search: a chunk's vertex, documents by property, mirrored paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import elements as E
from ..operators import graph as G
from ..operators import index as I
from ..operators import jobs as J
from ..operators import pages as P
from .catalogue import LINES, docs, query
from .more import _REC, _V, _chunks

_JOBS = "j AS (SELECT event_type AS queue, event_id AS job_id, epoch_us(ts) // 1000 AS \"at\", 60000 * (event_id % 43) + 1000 * (event_id % 7) AS lasts FROM events)"


@query(f"""WITH {_JOBS}, s AS (SELECT *, CAST(sum(lasts) OVER (PARTITION BY queue ORDER BY "at", job_id) AS BIGINT) AS s FROM j),
m AS (SELECT *, s + max("at" - s + lasts) OVER (PARTITION BY queue ORDER BY "at", job_id) AS ends FROM s) SELECT queue, job_id, ends - lasts AS begins, ends FROM m""")
def job_times(spark, sf):
    jobs = docs(spark, sf, "events").selectExpr("event_type AS queue", "event_id AS job_id", "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ)) AS at", "60000 * (event_id % 43) + 1000 * (event_id % 7) AS lasts")
    return J.served(jobs).select("queue", "job_id", "begins", "ends")


@query("SELECT event_id, 'TypeError' || ': ' || coalesce(props, '') AS error FROM events WHERE event_type = 'error'")
def job_failures(spark, sf):
    return docs(spark, sf, "events").where("event_type = 'error'").select("event_id", J.failure(F.lit("TypeError"), F.col("props")).alias("error"))


@query(f"WITH {LINES}, p AS (SELECT DISTINCT doc_id, page_no FROM id_) SELECT doc_id, count(*) AS missing, string_agg(page_no, ', ' ORDER BY page_no) AS pages FROM p WHERE (doc_id + page_no) % 5 = 0 GROUP BY doc_id")
def job_missing_pages(spark, sf):
    e = E.line_elements(docs(spark, sf)).select("doc_id", "page_no")
    return J.left_out(e, e.where("(doc_id + page_no) % 5 <> 0"))


@query(f"{_REC}, n AS (SELECT doc_id, count(*) AS chunks FROM rec_ GROUP BY 1) SELECT doc_id, count(*) AS elements, max(page_no) AS pages, coalesce(any_value(chunks), 0) AS chunks FROM id_ LEFT JOIN n USING (doc_id) GROUP BY doc_id")
def job_progress(spark, sf):
    found, e = _chunks(spark, sf)
    return J.progress(e, found.withColumn("doc_id", F.col("filename").cast("long")))


@query(f"{_REC}, {_V}, pg_ AS (SELECT id, first(page_no ORDER BY doc_id, page_no) AS page_no FROM id_ GROUP BY id) SELECT chunk_id, id AS vid, tag, page_no FROM rec_ JOIN vx_ ON id = graph_node_id JOIN pg_ USING (id)")
def chunk_nodes(spark, sf):
    found, e = _chunks(spark, sf)
    return I.nodes_of(found, G.vertices(e))


def _documents(spark, sf):
    path = E.identity(F.concat(F.lit("docs/"), F.coalesce("source", F.lit("none")), F.lit("/"), F.col("doc_id"), F.lit(".txt")))
    return docs(spark, sf).select(path.alias("p"), "lang").select(E.document_vid(F.col("p.key")).alias("vid"), "p.collection", "p.filename", "lang")


@query("SELECT 'doc_docs/' || coalesce(source, 'none') || '/' || doc_id AS vid, coalesce(source, 'none') AS collection, CAST(doc_id AS VARCHAR) AS filename, lang FROM documents WHERE coalesce(source, 'none') = 'src3' AND lang IS NOT DISTINCT FROM 'en'")
def graph_filtered(spark, sf):
    return G.matching(_documents(spark, sf), collection="src3", lang="en")


@query("SELECT doc_id, '.cleaned/docs/' || coalesce(source, 'none') || '/' || doc_id || '.html' AS path, 'docs/' || coalesce(source, 'none') || '/' || doc_id AS key FROM documents")
def html_mirror(spark, sf):
    path = P.mirrored(F.concat(F.lit("/docs\\"), F.coalesce("source", F.lit("none")), F.lit("/"), F.col("doc_id"), F.lit(".html")))
    return docs(spark, sf).select("doc_id", path.alias("path")).select("doc_id", "path", E.identity(F.col("path"))["key"].alias("key"))
