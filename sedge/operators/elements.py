"""Documents to elements: identity, ids, positions, heading tree, sections, captions.

Every window is partitioned by document, so the work spreads over documents and no order is global.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folds import scan
from ..functions.text import stripped

#: Tag of each label; any other label is a Paragraph.
TAGS = {"text": "Paragraph", "paragraph": "Paragraph", "heading": "SectionHeader", "section_header": "SectionHeader", "title": "SectionHeader", "list_item": "ListItem", "table": "Table", "picture": "Picture", "formula": "Formula", "code": "Code", "caption": "Caption", "footnote": "Footnote", "page_header": "PageHeader", "page_footer": "PageFooter"}
HEADINGS = ["heading", "section_header", "title"]
DEEPEST = 3
#: So many heading ranks are derived for lines.
RANKS = 13


def identity(path: Column) -> Column:
    """struct<source_path, key, filename, collection> of a path."""
    clean = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "^/+|/+$", "")
    parts = F.filter(F.split(clean, "/"), lambda x: (x != "") & (x != ".cleaned"))
    name = F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]*$", "")
    key = F.array_join(F.concat(F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(name)), "/")
    return F.struct(clean.alias("source_path"), key.alias("key"), name.alias("filename"), F.when(F.size(parts) >= 3, F.get(parts, 1)).otherwise("").alias("collection"))


def element_id(key: Column, page: Column, position: Column, text: Column) -> Column:
    """First ten hex digits of the digest of key, page, position and the text's first 50 characters."""
    return F.substring(F.sha2(F.concat_ws("|", key, page.cast("string"), position.cast("string"), F.substring(text, 1, 50)), 256), 1, 10)


def item_text(text: Column, table: Column | None = None) -> Column:
    """An item's text without white space at its ends; where it has none its table's text, else ''."""
    other = F.lit(None).cast("string") if table is None else table
    return F.coalesce(F.nullif(stripped(text), F.lit("")), other, F.lit(""))


def first_provenance(places: Column) -> Column:
    """The first of an item's places, null if it has none."""
    return F.get(places, F.lit(0))


def image_url(sent: Column, uri: Column) -> Column:
    """Where an image was sent, else its own address if it is one of the web's, else ''."""
    return F.coalesce(F.nullif(sent, F.lit("")), F.when(F.startswith(uri, F.lit("http")), uri), F.lit(""))


def tag_of(label: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in TAGS.items() for x in pair])
    return F.coalesce(F.element_at(known, F.lower(label)), F.lit("Paragraph"))


def document_vid(key: Column, limit: int = 256) -> Column:
    """Graph id of a document; a long key is cut to bytes on a character's edge and gets a digest.

    A UTF-8 prefix of whole characters is found without leaving the JVM: the longest prefix of
    characters whose bytes fit.
    """
    vid = F.concat(F.lit("doc_"), key)
    # a character has at least one byte, so no prefix of more characters than bytes can fit
    head = F.substring(vid, F.lit(1), F.lit(limit - 11))
    fits = F.filter(F.sequence(F.lit(0), F.char_length(head)), lambda n: F.octet_length(F.substring(head, F.lit(1), n)) <= limit - 11)
    return F.when(F.octet_length(vid) <= limit, vid).otherwise(F.concat(F.substring(vid, F.lit(1), F.array_max(fits)), F.lit("_"), F.substring(F.sha2(key, 256), 1, 10)))


def with_positions(elements: DataFrame) -> DataFrame:
    """Adds order (from 0 in the document) and page_position (from 0 on the page)."""
    doc, page = Window.partitionBy("doc_id").orderBy("pos"), Window.partitionBy("doc_id", "page_no").orderBy("pos")
    return elements.withColumn("order", F.row_number().over(doc) - 1).withColumn("page_position", F.row_number().over(page) - 1)


def with_ids(elements: DataFrame) -> DataFrame:
    return elements.withColumn("id", element_id(F.col("key"), F.col("page_no"), F.col("page_position"), F.col("text")))


def with_headings(elements: DataFrame, ranks: int | None = None) -> DataFrame:
    """Adds reference_id, depth and section_title.

    A heading's parent is the last earlier heading of a smaller rank; a missing rank is 0.  Other elements
    belong to the last heading, one level below it.  If all ranks are known to lie below ``ranks``, parents
    are found by running maxima, one for each rank, with no shuffle but that by document; a rank beyond is
    an error.  Otherwise a fold over each document's headings finds them, whatever the ranks.
    """
    got = elements.withColumn("__rank", F.coalesce("heading_rank", F.lit(0))).withColumn("__heading", F.lower("label").isin(HEADINGS))
    got = _by_fold(got) if ranks is None else _by_maxima(got, ranks)
    until = Window.partitionBy("doc_id").orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("__heading"), F.struct("id", "text", "__depth")), ignorenulls=True).over(until)
    got = got.withColumn("__section", last)
    return got.select(
        *elements.columns,
        F.coalesce(F.when(F.col("__heading"), F.col("__parent")).otherwise(F.col("__section.id")), F.lit("DOC")).alias("reference_id"),
        F.when(F.col("__heading"), F.col("__depth")).otherwise(F.coalesce(F.col("__section.__depth") + 1, F.lit(0))).alias("depth"),
        F.coalesce("__section.text", F.lit("")).alias("section_title"),
    )


def _by_maxima(got: DataFrame, ranks: int) -> DataFrame:
    before = Window.partitionBy("doc_id").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("__rank").between(0, ranks - 1)
    got = got.withColumn("__rank", F.when(known | ~F.col("__heading"), F.col("__rank")).otherwise(F.raise_error(F.concat(F.lit("a heading's rank is not below the given bound: "), F.col("__rank").cast("string"))).cast("int")))
    for r in range(ranks):
        own = F.when(F.col("__heading") & (F.col("__rank") == r), F.struct("order", "id"))
        got = got.withColumn(f"__last{r}", F.max(own).over(before))
    parent, depth, top = F.lit(None).cast("struct<order:int,id:string>"), F.lit(0), F.lit(-1)
    for r in range(ranks):
        at = F.coalesce(F.col(f"__last{r}.order"), F.lit(-1))
        open_ = (F.lit(r) < F.col("__rank")) & (at > top)
        parent = F.when(open_, F.col(f"__last{r}")).otherwise(parent)
        depth = depth + F.when(open_, 1).otherwise(0)
        top = F.greatest(top, F.when(F.lit(r) < F.col("__rank"), at).otherwise(F.lit(-1)))
    # a projection for each rank keeps the nested conditions from being written out again and again
    return got.withColumn("__parent", parent["id"]).withColumn("__depth", F.least(depth, F.lit(DEEPEST)))


def _by_fold(got: DataFrame) -> DataFrame:
    """Each document's headings with the stack of those still open, in one scan."""
    item = "struct<order:int,id:string,rank:int,depth:int>"

    def step(stack: Column, h: Column) -> tuple[Column, Column]:
        # ranks grow along the stack, so those of a smaller rank are what is left after popping
        left = F.filter(stack, lambda s: s["rank"] < h["rank"])
        top = F.get(left, F.size(left) - 1)
        own = F.struct(h["order"].alias("order"), h["id"].alias("id"), h["rank"].alias("rank"), F.least(F.coalesce(top["depth"] + 1, F.lit(0)), F.lit(DEEPEST)).alias("depth")).cast(item)
        return F.array_append(left, own), F.struct(h["order"].alias("order"), top["id"].alias("parent"), own["depth"].alias("depth"))

    heads = got.where("__heading").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("order", "id", F.col("__rank").alias("rank")))).alias("h"))
    found = heads.select("doc_id", F.inline(scan(F.col("h"), F.array().cast(f"array<{item}>"), step, f"array<{item}>", "struct<order:int,parent:string,depth:int>")))
    return got.join(found.select("doc_id", "order", F.col("parent").alias("__parent"), F.col("depth").alias("__depth")), ["doc_id", "order"], "left")


def with_ref_positions(elements: DataFrame) -> DataFrame:
    """Adds ref_position, the rank under the parent."""
    own = Window.partitionBy("doc_id", "reference_id").orderBy("order")
    return elements.withColumn("ref_position", F.row_number().over(own) - 1)


def caption_links(elements: DataFrame, batch: Column | None = None) -> DataFrame:
    """(doc_id, src, dst) of captions and the last table or picture before them in the same batch."""
    batch = F.lit(0) if batch is None else batch
    before = Window.partitionBy("doc_id", "__batch").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    visual = F.last(F.when(tag_of(F.col("label")).isin("Table", "Picture"), F.col("id")), ignorenulls=True).over(before)
    return elements.withColumn("__batch", batch).withColumn("dst", visual).where((tag_of(F.col("label")) == "Caption") & F.col("dst").isNotNull()).select("doc_id", F.col("id").alias("src"), "dst")


def line_elements(docs: DataFrame, lines_a_page: int = 10) -> DataFrame:
    """Lines of documents as elements, with labels and ranks derived from their place and length.

    The input has no layout: label follows (doc_id + line) mod 10, rank is the length mod ``RANKS``.
    """
    rows = docs.select("doc_id", F.concat(F.lit("docs/"), F.coalesce("source", F.lit("none")), F.lit("/"), F.col("doc_id"), F.lit(".txt")).alias("path"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    kind = (F.col("doc_id") + F.col("pos")) % 10
    label = F.when(kind == 0, "section_header").when(kind == 7, "picture").when(kind == 8, "caption").when(kind == 5, "list_item").otherwise("text")
    return rows.select("doc_id", identity(F.col("path"))["key"].alias("key"), "pos", (F.floor(F.col("pos") / lines_a_page) + 1).cast("int").alias("page_no"), F.trim("line").alias("text"), label.alias("label"), (F.length(F.trim("line")) % RANKS).alias("heading_rank"))


def structured(docs: DataFrame) -> DataFrame:
    """Elements of documents with ids, positions, heading tree and sections, divided by document.

    Documents are dealt out whole, before they become lines: that moves less, and no later step that goes by
    document moves anything.
    """
    return with_ref_positions(with_headings(with_ids(with_positions(line_elements(docs.repartition("doc_id")))), ranks=RANKS))
