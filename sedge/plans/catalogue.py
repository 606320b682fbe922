"""The query catalogue with DuckDB SQL for every query that SQL can express.

The documents have no layout, so labels, ranks, pages and references are derived from a line's place and
length (``operators.elements.line_elements``), and bookmarks and titles from them, in the same way in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunks as C
from ..operators import elements as E
from ..operators import graph as G
from ..operators import matter as M
from ..operators import reports as R
from ..operators import vectors as V
from ..sources import files as S

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        FOUND[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def docs(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- SQL shared by the oracles --------------------------------------------------------------------

MARKED, PLAIN = T.accents()
LINES = """
doc_ AS (SELECT doc_id, 'docs/' || coalesce(source, 'none') || '/' || doc_id AS key, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line_ AS (SELECT doc_id, key, i - 1 AS pos, trim(l[i]) AS text FROM doc_, range(1, len(l) + 1) AS r(i)),
lab_ AS (SELECT *, CAST(floor(pos / 10) + 1 AS INTEGER) AS page_no, length(text) % 13 AS heading_rank,
  CASE (doc_id + pos) % 10 WHEN 0 THEN 'section_header' WHEN 7 THEN 'picture' WHEN 8 THEN 'caption' WHEN 5 THEN 'list_item' ELSE 'text' END AS label FROM line_),
pos_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS ord, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY pos) - 1 AS page_position FROM lab_),
id_ AS (SELECT *, left(sha256(key || '|' || page_no || '|' || page_position || '|' || left(text, 50)), 10) AS id FROM pos_)"""
#: The heading tree by a search for the last earlier smaller rank, unlike the running maxima of the query.
TREE = f"""{LINES},
head_ AS (SELECT * FROM id_ WHERE label = 'section_header'),
par_ AS (SELECT h.doc_id, h.ord, max(p.ord) AS pord FROM head_ h LEFT JOIN head_ p ON p.doc_id = h.doc_id AND p.ord < h.ord AND p.heading_rank < h.heading_rank GROUP BY 1, 2),
dep_(doc_id, ord, depth) AS (SELECT doc_id, ord, 0 FROM par_ WHERE pord IS NULL UNION ALL SELECT par_.doc_id, par_.ord, dep_.depth + 1 FROM par_ JOIN dep_ ON par_.doc_id = dep_.doc_id AND par_.pord = dep_.ord),
ht_ AS (SELECT h.doc_id, h.ord, h.id, h.text, least(3, dep_.depth) AS depth, p.id AS parent FROM head_ h JOIN dep_ USING (doc_id, ord) JOIN par_ USING (doc_id, ord) LEFT JOIN id_ p ON p.doc_id = h.doc_id AND p.ord = par_.pord),
sec_ AS (SELECT e.*, (SELECT max(h.ord) FROM head_ h WHERE h.doc_id = e.doc_id AND h.ord <= e.ord) AS hord FROM id_ e),
tree_ AS (SELECT s.doc_id, s.key, s.pos, s.page_no, s.text, s.label, s.ord, s.page_position, s.id,
  coalesce(CASE WHEN s.label = 'section_header' THEN ht_.parent ELSE ht_.id END, 'DOC') AS reference_id,
  CASE WHEN s.label = 'section_header' THEN ht_.depth ELSE coalesce(ht_.depth + 1, 0) END AS depth, coalesce(ht_.text, '') AS section_title
  FROM sec_ s LEFT JOIN ht_ ON ht_.doc_id = s.doc_id AND ht_.ord = s.hord),
ref_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, reference_id ORDER BY ord) - 1 AS ref_position FROM tree_)"""
EDGES = f"""{TREE},
vis_ AS (SELECT doc_id, label, id, last_value(CASE WHEN label = 'picture' THEN id END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS dst FROM id_),
edge_ AS (SELECT doc_id, CASE WHEN reference_id = 'DOC' THEN 'doc_' || key ELSE reference_id END AS src, id AS dst, 'PARENT_OF' AS edge_type, CAST(ord AS INTEGER) AS sequence, CAST(NULL AS VARCHAR) AS relation FROM tree_
  UNION ALL SELECT doc_id, id, dst, 'LINKED_TO', NULL, 'describes' FROM vis_ WHERE label = 'caption' AND dst IS NOT NULL)"""
FOLD = f"translate(lower(coalesce(text, '')), '{MARKED}', '{PLAIN}')"
_titles = ", ".join(f"'{t}'" for t in T.SKIP_TITLES)
#: Headings as bookmarks, two lines to a page; some have the title of front or back matter.
SPANS = f"""{LINES},
toc(doc, pos, level, title, page) AS (SELECT doc_id, ord, 1 + heading_rank % 3, CASE ord % 4 WHEN 0 THEN 'Index' WHEN 1 THEN '2. Contents' ELSE text END, CAST(floor(pos / 2) + 1 AS INTEGER) FROM id_ WHERE label = 'section_header'),
tot(doc, pages) AS (SELECT doc_id, CAST(floor(max(pos) / 2) + 1 AS INTEGER) FROM id_ GROUP BY 1),
span_ AS (SELECT a.doc, a.pos, a.level, a.title, a.page AS start, coalesce((SELECT arg_min(b.page, b.pos) FROM toc b WHERE b.doc = a.doc AND b.pos > a.pos AND b.level <= a.level AND b.page > a.page) - 1, t.pages) AS "end", t.pages
  FROM toc a JOIN tot t ON t.doc = a.doc WHERE a.page BETWEEN 1 AND t.pages),
skip_ AS (SELECT DISTINCT doc, p AS page FROM span_, range(start, "end" + 1) AS r(p) WHERE regexp_replace(lower(title), '^2\\. ', '') IN ({_titles}) AND "end" - start + 1 <= greatest(1, CAST(floor(pages * 0.35) AS INTEGER))),
kept_ AS (SELECT doc, p AS page, p - row_number() OVER (PARTITION BY doc ORDER BY p) AS g FROM tot, range(1, pages + 1) AS r(p) WHERE (doc, p) NOT IN (SELECT (doc, page) FROM skip_)),
range_ AS (SELECT doc, min(page) AS first, max(page) AS last FROM kept_ GROUP BY doc, g)"""


def _toc(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = E.with_positions(E.line_elements(docs(spark, sf), lines_a_page=2))
    title = F.when(F.col("order") % 4 == 0, "Index").when(F.col("order") % 4 == 1, "2. Contents").otherwise(F.col("text"))
    toc = e.where("label = 'section_header'").select(F.col("doc_id").alias("doc"), F.col("order").alias("pos"), (1 + F.col("heading_rank") % 3).alias("level"), title.alias("title"), F.col("page_no").alias("page"))
    return toc, e.groupBy(F.col("doc_id").alias("doc")).agg(F.max("page_no").alias("pages"))


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    return M.toc_spans(*_toc(spark, sf))


def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    return M.kept_ranges(_toc(spark, sf)[1], M.skipped_pages(_spans(spark, sf)))


# --- identity, ids, change, duplicates ------------------------------------------------------------


@query("SELECT doc_id, 'docs/' || source || '/' || doc_id || '.txt' AS source_path, 'docs/' || source || '/' || doc_id AS key, CAST(doc_id AS VARCHAR) AS filename, source AS collection, 'doc_docs/' || source || '/' || doc_id AS vid FROM documents")
def doc_identity(spark, sf):
    path = F.concat(F.lit("docs/"), "source", F.lit("/"), F.col("doc_id"), F.lit(".txt"))
    found = docs(spark, sf).select("doc_id", E.identity(path).alias("i"))
    return found.select("doc_id", "i.*", E.document_vid(F.col("i.key")).alias("vid"))


@query(f"WITH {LINES} SELECT doc_id, CAST(ord AS INTEGER) AS \"order\", page_no, CAST(page_position AS INTEGER) AS page_position, id FROM id_")
def element_ids(spark, sf):
    return E.with_ids(E.with_positions(E.line_elements(docs(spark, sf)))).select("doc_id", "order", "page_no", "page_position", "id")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0 OR doc_id % 3 = 1 AND n_chars % 2 = 1")
def change_detection(spark, sf):
    files = docs(spark, sf).select("doc_id", F.col("doc_id").cast("string").alias("partition_key"), (1000 + F.col("n_chars") % 2).alias("modified"))
    manifest = docs(spark, sf).where("doc_id % 3 <> 0").select(F.col("doc_id").cast("string").alias("partition_key"), F.when(F.col("doc_id") % 3 == 1, 1000 + (F.col("n_chars") + 1) % 2).otherwise(2000).alias("modified"))
    return S.changed(files, manifest).select("doc_id")


@query("SELECT doc_id, sha256(coalesce(text, '')) AS content_hash, CASE WHEN min(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) < doc_id THEN min(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) END AS duplicate_of FROM documents")
def exact_dedup(spark, sf):
    return S.duplicates(docs(spark, sf).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash")))


# --- language, titles, pages ----------------------------------------------------------------------

_lists = ", ".join(f"('{lang}', {k}, '{words}')" for k, (lang, words) in enumerate(T.WORDS.items()))
#: Words of one language alone are found by counting here, unlike in the query.
LANG = f"""raw(lang, k, words) AS (VALUES {_lists}), each_word AS (SELECT DISTINCT lang, unnest(string_split(words, ' ')) AS w FROM raw), langs AS (SELECT lang, k FROM raw),
own AS (SELECT w, any_value(lang) AS lang FROM each_word GROUP BY w HAVING count(*) = 1),
tok AS (SELECT doc_id, regexp_extract_all({FOLD}, '[a-z]+') AS t FROM documents),
cnt AS (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest(t) AS w FROM tok) GROUP BY ALL),
sc AS (SELECT doc_id, len(t) AS n, langs.lang, k, coalesce((SELECT sum(c) FROM cnt JOIN own USING (w) WHERE cnt.doc_id = tok.doc_id AND own.lang = langs.lang), 0) AS s FROM tok, langs),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, k) AS r FROM sc),
det AS (SELECT a.doc_id, CASE WHEN a.n < 30 OR a.s < 0.02 * a.n OR (b.s > 0 AND a.s < 1.5 * b.s) THEN '' ELSE a.lang END AS language FROM rk a JOIN rk b USING (doc_id) WHERE a.r = 1 AND b.r = 2)"""


@query(f"WITH {LANG} SELECT doc_id, language FROM det")
def language_detect(spark, sf):
    return docs(spark, sf).select("doc_id", T.detect_language(F.coalesce("text", F.lit(""))).alias("language"))


@query(f"WITH {LANG} SELECT lang, language, count(*) AS n FROM det JOIN documents USING (doc_id) GROUP BY ALL")
def language_confusion(spark, sf):
    return docs(spark, sf).groupBy("lang", T.detect_language(F.coalesce("text", F.lit(""))).alias("language")).agg(F.count("*").alias("n"))


@query(f"WITH {LINES}, b AS (SELECT doc_id, pos, text, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM line_ WHERE text <> '') SELECT doc_id, string_agg(text, ' ' ORDER BY pos) AS sample FROM b WHERE before < 20000 GROUP BY doc_id")
def language_sample(spark, sf):
    return T.language_sample(E.line_elements(docs(spark, sf)))


_NAMES = "CASE doc_id % 7 WHEN 0 THEN (doc_id % 30) || '. ' WHEN 1 THEN 'IV) ' WHEN 2 THEN 'B. ' ELSE '' END || CASE doc_id % 5 WHEN 0 THEN ['Dédicace', 'Back  Cover', 'COLOPHON', 'Table des Matières'][doc_id % 4 + 1] ELSE left(split_part(coalesce(text, ''), chr(10), 1), 30) END"
_low = f"trim(translate(lower(title), '{MARKED}', '{PLAIN}'))"


@query(f"""WITH t AS (SELECT doc_id, {_NAMES} AS title FROM documents), c AS (SELECT doc_id, {_low} AS low, regexp_replace({_low}, '^(?:[0-9]+[.)\\-–—]?|[ivxlcdm]+[.)\\-–—]|[a-z][.)\\-–—])\\s+', '') AS cut FROM t),
n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(CASE WHEN length(cut) > 0 THEN cut ELSE low END, '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS normal FROM c) SELECT doc_id, normal, normal IN ({_titles}) AS skipped FROM n""")
def title_filter(spark, sf):
    names = F.get(F.array(*map(F.lit, ["Dédicace", "Back  Cover", "COLOPHON", "Table des Matières"])), (F.col("doc_id") % 4).cast("int"))
    number = F.when(F.col("doc_id") % 7 == 0, F.concat((F.col("doc_id") % 30).cast("string"), F.lit(". "))).when(F.col("doc_id") % 7 == 1, "IV) ").when(F.col("doc_id") % 7 == 2, "B. ").otherwise("")
    first = F.substring(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1), 1, 30)
    title = F.concat(number, F.when(F.col("doc_id") % 5 == 0, names).otherwise(first))
    return docs(spark, sf).select("doc_id", T.normal_title(title).alias("normal"), T.is_matter(title).alias("skipped"))


@query("""WITH l AS (SELECT doc_id, [y for y in [trim(x) for x in string_split(coalesce(text, ''), chr(10))] if y <> ''] AS l FROM documents)
SELECT doc_id, len(l) >= 15 AND len([x for x in l if regexp_matches(x, '[0-9]+\\s*(?:[,\\-–]\\s*[0-9]+\\s*)*$')]) >= 0.55 * len(l) AND coalesce(list_sum([length(x) for x in l]), 0) / len(l) <= 60 AS shaped FROM l""")
def index_shape(spark, sf):
    return docs(spark, sf).select("doc_id", F.coalesce(T.index_shaped(F.col("text")), F.lit(False)).alias("shaped"))


@query("SELECT source, avg(length(trim(coalesce(text, '')))) >= 50 AS text_layer FROM documents GROUP BY source")
def text_layer(spark, sf):
    return docs(spark, sf).groupBy("source").agg((F.avg(F.length(F.trim(F.coalesce("text", F.lit(""))))) >= 50).alias("text_layer"))


@query(f"WITH {SPANS} SELECT * FROM span_")
def toc_spans(spark, sf):
    return _spans(spark, sf)


@query(f"WITH {SPANS} SELECT doc, page FROM skip_")
def skip_pages(spark, sf):
    return M.skipped_pages(_spans(spark, sf))


@query(f"WITH {SPANS} SELECT * FROM range_")
def kept_ranges(spark, sf):
    return _ranges(spark, sf)


@query(f"WITH {SPANS} SELECT doc, f AS first, least(f + 4, last) AS last FROM range_, range(first, last + 1, 5) AS r(f)")
def page_batches(spark, sf):
    return M.page_batches(_ranges(spark, sf))


@query(f"WITH {SPANS}, k AS (SELECT doc, page, row_number() OVER (PARTITION BY doc ORDER BY page) - 1 AS i, count(*) OVER (PARTITION BY doc) AS n FROM kept_) SELECT doc, page FROM k WHERE n <= 20 OR i IN (SELECT CAST(floor(j * n / 20) AS BIGINT) FROM range(0, 20) AS r(j))")
def sample_pages(spark, sf):
    return M.sampled_pages(_ranges(spark, sf))


# --- structure ------------------------------------------------------------------------------------


@query(f"WITH RECURSIVE {TREE} SELECT doc_id, id, reference_id, CAST(depth AS INTEGER) AS depth FROM tree_ WHERE label = 'section_header'")
def heading_tree(spark, sf):
    return E.structured(docs(spark, sf)).where("label = 'section_header'").select("doc_id", "id", "reference_id", "depth")


@query(f"WITH RECURSIVE {TREE} SELECT doc_id, CAST(ord AS INTEGER) AS \"order\", reference_id, CAST(depth AS INTEGER) AS depth, section_title FROM tree_")
def section_titles(spark, sf):
    return E.structured(docs(spark, sf)).select("doc_id", "order", "reference_id", "depth", "section_title")


@query(f"WITH RECURSIVE {TREE} SELECT doc_id, CAST(ord AS INTEGER) AS \"order\", CAST(ref_position AS INTEGER) AS ref_position FROM ref_")
def ref_positions(spark, sf):
    return E.structured(docs(spark, sf)).select("doc_id", "order", "ref_position")


@query(f"WITH RECURSIVE {EDGES} SELECT doc_id, src, dst FROM edge_ WHERE edge_type = 'LINKED_TO'")
def caption_links(spark, sf):
    return E.caption_links(E.with_ids(E.with_positions(E.line_elements(docs(spark, sf)))))


FONT = "s AS (SELECT l_orderkey AS doc, round(l_quantity, 1) AS size, sum(l_linenumber * 10) AS chars FROM lineitem GROUP BY ALL), b AS (SELECT doc, size AS body FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY chars DESC, size) AS r FROM s) WHERE r = 1)"


@query(f"WITH {FONT} SELECT doc, size, CAST(dense_rank() OVER (PARTITION BY doc ORDER BY size DESC) - 1 AS INTEGER) AS rank FROM s JOIN b USING (doc) WHERE size > body")
def font_ranks(spark, sf):
    return M.font_ranks(docs(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_quantity").alias("size"), (F.col("l_linenumber") * 10).alias("chars")))


BOX = "x AS (SELECT l_orderkey AS doc, 1 AS page, l_linenumber AS \"order\", l_suppkey % 50 AS l, l_suppkey % 50 + l_quantity AS r, l_partkey % 50 AS b, l_partkey % 50 + l_quantity AS t FROM lineitem)"


@query(f"WITH {BOX} SELECT doc, \"order\" FROM x h WHERE \"order\" % 2 = 0 AND NOT EXISTS (SELECT 1 FROM x f WHERE f.\"order\" % 2 = 1 AND f.doc = h.doc AND f.\"order\" < h.\"order\" AND f.l - 2 <= h.l AND h.r <= f.r + 2 AND f.b - 2 <= h.b AND h.t <= f.t + 2)")
def figure_containment(spark, sf):
    x = docs(spark, sf, "lineitem").selectExpr("l_orderkey doc", "1 page", "l_linenumber `order`", "l_suppkey % 50 l", "l_suppkey % 50 + l_quantity r", "l_partkey % 50 b", "l_partkey % 50 + l_quantity t")
    return M.outside_figures(x.where("`order` % 2 = 0"), x.where("`order` % 2 = 1")).select("doc", "order")


# --- chunks ---------------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE {TREE},
con_ AS (SELECT doc_id, ord, id, label, reference_id, trim(text) AS text, CASE WHEN label IN ('text', 'list_item', 'caption') THEN 'prose' ELSE '' END AS family, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS i FROM tree_ WHERE regexp_matches(text, '[\\p{{L}}\\p{{N}}]')),
blk_(doc_id, i, family, reference_id, size, number) AS (SELECT doc_id, i, family, reference_id, length(text), 0 FROM con_ WHERE i = 1
  UNION ALL SELECT c.doc_id, c.i, c.family, c.reference_id, CASE WHEN c.family <> '' AND c.family = b.family AND c.reference_id = b.reference_id AND b.size + 1 + length(c.text) <= 450 THEN b.size + 1 + length(c.text) ELSE length(c.text) END,
    CASE WHEN c.family <> '' AND c.family = b.family AND c.reference_id = b.reference_id AND b.size + 1 + length(c.text) <= 450 THEN b.number ELSE b.number + 1 END
  FROM blk_ b JOIN con_ c ON c.doc_id = b.doc_id AND c.i = b.i + 1),
fus_ AS (SELECT c.doc_id, number, count(*) AS n, arg_min(c.id, c.i) AS anchor, string_agg(c.text, chr(10) ORDER BY c.i) AS text FROM con_ c JOIN blk_ USING (doc_id, i) GROUP BY ALL)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY number) - 1 AS INTEGER) AS block, anchor, CAST(n AS INTEGER) AS n_elements, text FROM fus_ WHERE length(text) >= 24""")
def blocks(spark, sf):
    return C.build_blocks(E.structured(docs(spark, sf))).select("doc_id", "block", "anchor", F.size("element_ids").alias("n_elements"), "text")


@query("""WITH RECURSIVE d AS (SELECT doc_id, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM documents),
w(doc_id, t, s, e) AS (
  SELECT doc_id, t, 0, CASE WHEN length(t) <= 450 THEN length(t) WHEN strpos(reverse(substr(t, 376, 75)), ' ') > 0 THEN 450 - strpos(reverse(substr(t, 376, 75)), ' ') ELSE 450 END FROM d WHERE t <> ''
  UNION ALL
  SELECT doc_id, t, n, CASE WHEN n + 450 >= length(t) THEN length(t) WHEN strpos(reverse(substr(t, n + 376, 75)), ' ') > 0 THEN n + 450 - strpos(reverse(substr(t, n + 376, 75)), ' ') ELSE n + 450 END
  FROM (SELECT doc_id, t, greatest(e - 75, s + 1) AS n FROM w WHERE e < length(t)))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_index, trim(substr(t, s + 1, e - s), ' ' || chr(9) || chr(10) || chr(13)) AS chunk FROM w""")
def chunk_windows(spark, sf):
    return C.chunk_windows(docs(spark, sf))


REFS = f"""{LINES}, c AS (SELECT doc_id, floor(ord / 3) AS chunk, [CASE WHEN x % 7 = 6 THEN '#/tables/' || x ELSE '#/texts/' || floor(x / 5)::BIGINT END for x in list(ord ORDER BY ord)] AS refs FROM pos_ GROUP BY ALL),
el AS (SELECT doc_id, '#/texts/' || (ord // 5) AS self_ref, arg_max(id, ord) AS id FROM id_ GROUP BY ALL),
m AS (SELECT c.doc_id, chunk, i, el.id FROM c, range(1, len(refs) + 1) AS r(i), el WHERE el.doc_id = c.doc_id AND el.self_ref = refs[i]),
f AS (SELECT doc_id, chunk, arg_min(id, i) AS id, greatest(1, count(*)) AS block_size FROM m GROUP BY ALL),
a AS (SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, id, block_size, CAST(row_number() OVER (PARTITION BY doc_id, id ORDER BY chunk) - 1 AS INTEGER) AS chunk_index, count(*) OVER (PARTITION BY doc_id, id) AS chunk_count FROM f)"""


def with_references(e: DataFrame) -> DataFrame:
    """Elements in chunks of three; five share a self_ref, and each refers to its own but for those to tables."""
    own = F.concat(F.lit("#/texts/"), F.floor(F.col("order") / 5).cast("string"))
    ref = F.when(F.col("order") % 7 == 6, F.concat(F.lit("#/tables/"), F.col("order"))).otherwise(own)
    return e.withColumns({"self_ref": own, "chunk": F.floor(F.col("order") / 3).cast("int"), "at": F.col("order"), "ref": ref})


@query(f"WITH {REFS} SELECT *, CASE WHEN chunk_count = 1 THEN id ELSE id || '#' || chunk_index END AS chunk_id FROM a")
def anchors(spark, sf):
    e = with_references(E.with_ids(E.with_positions(E.line_elements(docs(spark, sf).repartition("doc_id")))))
    return C.anchored(e).withColumn("chunk_id", C.chunk_id(F.col("id"), F.col("chunk_index"), F.col("chunk_count")))


@query(f"WITH RECURSIVE {TREE} SELECT doc_id, id, CASE WHEN trim(section_title) = '' OR starts_with(lower(ltrim(text)), lower(trim(section_title))) THEN text ELSE trim(section_title) || chr(10) || chr(10) || text END AS context FROM tree_")
def contextualized(spark, sf):
    return E.structured(docs(spark, sf)).select("doc_id", "id", C.contextualized(F.col("text"), F.col("section_title")).alias("context"))


@query(f"WITH RECURSIVE {TREE} SELECT id AS element_id, id AS graph_node_id, key AS filename, page_no, label, reference_id, CAST(depth AS INTEGER) AS depth, section_title, CAST(page_position AS INTEGER) AS page_position, CAST(ref_position AS INTEGER) AS ref_position, regexp_matches(text, '[\\p{{L}}\\p{{N}}]') AND length(text) >= 24 AS kept FROM ref_")
def chunk_metadata(spark, sf):
    e = E.structured(docs(spark, sf))
    return e.select(F.col("id").alias("element_id"), F.col("id").alias("graph_node_id"), F.col("key").alias("filename"), "page_no", "label", "reference_id", "depth", "section_title", "page_position", "ref_position", (T.has_content(F.col("text")) & (F.length("text") >= 24)).alias("kept"))


# --- graph ----------------------------------------------------------------------------------------


@query(f"WITH {LINES} SELECT id AS vid, any_value(CASE label WHEN 'section_header' THEN 'SectionHeader' WHEN 'picture' THEN 'Picture' WHEN 'caption' THEN 'Caption' WHEN 'list_item' THEN 'ListItem' ELSE 'Paragraph' END) AS tag FROM id_ GROUP BY id")
def graph_vertices(spark, sf):
    return G.vertices(E.with_ids(E.with_positions(E.line_elements(docs(spark, sf))))).select("vid", "tag")


@query(f"WITH RECURSIVE {EDGES} SELECT * FROM edge_")
def graph_edges(spark, sf):
    return G.edges(E.structured(docs(spark, sf)))


@query(f"WITH {LINES}, vis_ AS (SELECT label, last_value(CASE WHEN label = 'picture' THEN id END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS dst FROM id_) SELECT 'PARENT_OF' AS kind, count(*) AS n FROM id_ UNION ALL SELECT 'LINKED_TO', count(*) FROM vis_ WHERE label = 'caption' AND dst IS NOT NULL UNION ALL SELECT 'vertices', count(DISTINCT id) FROM id_ UNION ALL SELECT 'documents', count(*) FROM documents")
def graph_counts(spark, sf):
    e = E.structured(docs(spark, sf))
    parts = [G.edges(e).groupBy(F.col("edge_type").alias("kind")).agg(F.count("*").alias("n")), e.agg(F.count_distinct("id").alias("n")).select(F.lit("vertices").alias("kind"), "n"), docs(spark, sf).agg(F.count("*").alias("n")).select(F.lit("documents").alias("kind"), "n")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


UP = f"""{EDGES}, st_ AS (SELECT DISTINCT doc_id, dst AS node, src AS ancestor FROM edge_ WHERE edge_type = 'PARENT_OF'),
up_(doc_id, node, ancestor, hops) AS (SELECT doc_id, node, ancestor, 1 FROM st_ UNION ALL SELECT up_.doc_id, up_.node, st_.ancestor, hops + 1 FROM up_ JOIN st_ ON st_.doc_id = up_.doc_id AND st_.node = up_.ancestor)"""


@query(f"WITH RECURSIVE {UP} SELECT doc_id, node, CAST(max(hops) AS INTEGER) AS hops FROM up_ GROUP BY ALL")
def graph_ascend(spark, sf):
    return G.ancestors(G.edges(E.structured(docs(spark, sf)))).groupBy("doc_id", "node").agg(F.max("hops").alias("hops"))


@query(f"WITH RECURSIVE {UP} SELECT doc_id, ancestor AS root, count(*) AS n FROM up_ GROUP BY ALL")
def graph_subtree(spark, sf):
    return G.ancestors(G.edges(E.structured(docs(spark, sf)))).groupBy("doc_id", F.col("ancestor").alias("root")).agg(F.count("*").alias("n"))


@query(f"WITH RECURSIVE {UP} SELECT CAST(hops AS INTEGER) AS hops, count(*) AS n FROM up_ GROUP BY hops")
def graph_path_lengths(spark, sf):
    return G.ancestors(G.edges(E.structured(docs(spark, sf)))).groupBy("hops").agg(F.count("*").alias("n"))


@query(f"WITH RECURSIVE {TREE} SELECT doc_id, reference_id, string_agg(text, chr(10) ORDER BY ord) AS context FROM tree_ GROUP BY ALL")
def graph_section_context(spark, sf):
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order", "text"))), lambda x: x["text"]), "\n")
    return E.structured(docs(spark, sf)).groupBy("doc_id", "reference_id").agg(told.alias("context"))


# --- vectors --------------------------------------------------------------------------------------


def _first(spark, sf) -> list[float]:
    return docs(spark, sf, "embeddings").where("vec_id = 0").select("embedding").first()[0]


_knn = lambda d, where="true": f"WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0) SELECT vec_id, label, round({d}, 6) AS distance FROM embeddings, q WHERE {where} ORDER BY {d}, vec_id LIMIT 20"
_L2 = "list_distance(CAST(embedding AS DOUBLE[]), q) ** 2"


@query(_knn(_L2))
def knn_l2(spark, sf):
    return V.nearest(docs(spark, sf, "embeddings"), _first(spark, sf)).withColumn("distance", F.round("distance", 6))


@query(_knn("1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), q)"))
def knn_cosine(spark, sf):
    return V.nearest(docs(spark, sf, "embeddings"), _first(spark, sf), metric="cosine").withColumn("distance", F.abs(F.round("distance", 6)))


@query(_knn(_L2, "label IN (1, 2)"))
def knn_filtered(spark, sf):
    return V.nearest(docs(spark, sf, "embeddings").where(F.col("label").isin(1, 2)), _first(spark, sf)).withColumn("distance", F.round("distance", 6))


@query(f"SELECT label, min(distance) AS best, count(*) AS n FROM ({_knn(_L2)}) GROUP BY label")
def knn_grouped(spark, sf):
    return V.grouped(V.nearest(docs(spark, sf, "embeddings"), _first(spark, sf)).withColumn("distance", F.round("distance", 6)))


@query()
def hash_embed(spark, sf):
    return V.hashed_embedding(docs(spark, sf))


# --- reports --------------------------------------------------------------------------------------


@query(f"WITH {LINES} SELECT count(*) AS chunks, count(DISTINCT doc_id) AS documents, count(*) FILTER (NOT regexp_matches(text, '[\\p{{L}}\\p{{N}}]')) AS noise, count(*) FILTER (length(text) < 40) AS weak, CAST(trunc(median(length(text))) AS INTEGER) AS median_length, CAST(trunc(avg(length(text))) AS INTEGER) AS mean_length, CAST(min(length(text)) AS INTEGER) AS shortest, CAST(max(length(text)) AS INTEGER) AS longest FROM line_")
def index_report(spark, sf):
    n = F.length("text")
    return E.line_elements(docs(spark, sf)).agg(F.count("*").alias("chunks"), F.count_distinct("doc_id").alias("documents"), F.count_if(~T.has_content(F.col("text"))).alias("noise"), F.count_if(n < 40).alias("weak"), F.median(n).cast("int").alias("median_length"), F.avg(n).cast("int").alias("mean_length"), F.min(n).alias("shortest"), F.max(n).alias("longest"))


@query(f"WITH RECURSIVE {TREE} SELECT deepest, count(*) AS documents, deepest <= 1 AS flat FROM (SELECT CAST(max(depth) AS INTEGER) AS deepest FROM tree_ GROUP BY doc_id) GROUP BY deepest")
def index_report_depth(spark, sf):
    return E.structured(docs(spark, sf)).groupBy("doc_id").agg(F.max("depth").alias("deepest")).groupBy("deepest").agg(F.count("*").alias("documents")).withColumn("flat", F.col("deepest") <= 1)


@query("SELECT coalesce(nullif(trim(lang), ''), 'indeterminee') AS language, count(*) AS n FROM documents GROUP BY 1")
def index_report_languages(spark, sf):
    return docs(spark, sf).groupBy(F.coalesce(F.nullif(F.trim("lang"), F.lit("")), F.lit("indeterminee")).alias("language")).agg(F.count("*").alias("n"))


@query(f"WITH {LINES} SELECT label, count(*) AS n FROM lab_ GROUP BY label ORDER BY n DESC, label LIMIT 10")
def index_report_labels(spark, sf):
    return E.line_elements(docs(spark, sf)).groupBy("label").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "label").limit(10)


@query(f"WITH {LINES} SELECT count(*) AS ids, count(*) FILTER (NOT regexp_matches(id, '^[a-f0-9]{{10}}$')) AS malformed, count(*) - count(DISTINCT id) AS repeated FROM id_")
def contract_check(spark, sf):
    e = E.with_ids(E.with_positions(E.line_elements(docs(spark, sf))))
    return e.agg(F.count("*").alias("ids"), F.count_if(~F.col("id").rlike("^[a-f0-9]{10}$")).alias("malformed"), (F.count("*") - F.count_distinct("id")).alias("repeated"))


_RUN = "CASE WHEN event_id % 10 = 0 THEN 'pending' WHEN event_id % 10 = 1 THEN 'running' WHEN event_id % 10 = 2 THEN 'failed' ELSE 'success' END"


@query(f"SELECT event_type AS queue, count(*) FILTER (s = 'pending') AS queued, count(*) FILTER (s = 'running') AS running, count(*) AS known FROM (SELECT event_type, {_RUN} AS s FROM events) GROUP BY 1")
def run_stats(spark, sf):
    s = F.expr(_RUN)
    return docs(spark, sf, "events").groupBy(F.col("event_type").alias("queue")).agg(F.count_if(s == "pending").alias("queued"), F.count_if(s == "running").alias("running"), F.count("*").alias("known"))


@query(f"WITH r AS (SELECT event_id, event_type AS queue, {_RUN} AS s FROM events), n AS (SELECT *, count(*) OVER (PARTITION BY queue) - row_number() OVER (PARTITION BY queue ORDER BY event_id) + 1 AS newest, min(CASE WHEN s IN ('pending', 'running') THEN event_id END) OVER (PARTITION BY queue) AS open FROM r) SELECT queue, event_id FROM n WHERE newest <= 500 OR event_id >= coalesce(open, event_id + 1)")
def run_pruning(spark, sf):
    runs = docs(spark, sf, "events").select("event_id", F.col("event_type").alias("queue"), F.expr(_RUN).alias("s"))
    return R.retained(runs).select("queue", "event_id")


@query("SELECT conv_id, turn, len(regexp_extract_all(text, '[0-9]+')) AS n, coalesce(array_to_string(regexp_extract_all(text, '[0-9]+'), ','), '') AS ids FROM conversations")
def citations(spark, sf):
    ids = F.regexp_extract_all(F.concat(F.regexp_replace("text", "([0-9]+)", "[src:$1]")), F.lit(r"\[(?:src|img):([0-9A-Za-z]+)\]"), F.lit(1))
    return docs(spark, sf, "conversations").select("conv_id", "turn", F.size(ids).cast("long").alias("n"), F.array_join(ids, ",").alias("ids"))


def queries() -> dict[str, Query]:
    from . import more, service  # noqa: F401  add their queries

    return dict(FOUND)


def oracle_sql() -> dict[str, str]:
    from . import more, service  # noqa: F401

    return dict(SQL)
