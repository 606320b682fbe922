"""Parts of paged documents: bookmark spans, pages to skip, kept ranges, samples, fonts, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import index_shaped, is_matter
from ..session import cut


def toc_spans(toc: DataFrame, totals: DataFrame) -> DataFrame:
    """(doc, pos, level, title, start, end): a bookmark reaches to the page before the next of its level or above.

    toc has (doc, pos, level, title, page); totals has (doc, pages).
    """
    a, b = toc.alias("a"), toc.alias("b")
    later = (F.col("a.doc") == F.col("b.doc")) & (F.col("b.pos") > F.col("a.pos")) & (F.col("b.level") <= F.col("a.level")) & (F.col("b.page") > F.col("a.page"))
    nexts = a.join(b, later, "left").groupBy("a.doc", "a.pos", "a.level", "a.title", F.col("a.page").alias("start")).agg(F.min_by("b.page", "b.pos").alias("next"))
    return nexts.join(totals, "doc").where((F.col("start") >= 1) & (F.col("start") <= F.col("pages"))).select("doc", "pos", "level", "title", "start", F.coalesce(F.col("next") - 1, F.col("pages")).alias("end"), "pages")


def skipped_pages(spans: DataFrame, titles: list[str] | None = None, share: float = 0.35) -> DataFrame:
    """(doc, page) of front and back matter; a span over a share of the pages is a misread bookmark."""
    most = F.greatest(F.lit(1), F.floor(F.col("pages") * share).cast("int"))
    kept = spans.where(is_matter(F.col("title"), titles) & (F.col("end") - F.col("start") + 1 <= most))
    return kept.select("doc", F.explode(F.sequence("start", "end")).alias("page")).distinct()


def kept_ranges(totals: DataFrame, skipped: DataFrame) -> DataFrame:
    """(doc, first, last): runs of pages that are not skipped."""
    pages = totals.select("doc", F.explode(F.sequence(F.lit(1), "pages")).alias("page")).join(skipped, ["doc", "page"], "left_anti")
    island = F.col("page") - F.row_number().over(Window.partitionBy("doc").orderBy("page"))
    return pages.withColumn("island", island).groupBy("doc", "island").agg(F.min("page").alias("first"), F.max("page").alias("last")).drop("island")


def page_batches(ranges: DataFrame, size: int = 5) -> DataFrame:
    """(doc, first, last) of batches of pages within a range."""
    starts = ranges.select("doc", "last", F.explode(F.sequence("first", "last", F.lit(size))).alias("start"))
    return starts.select("doc", F.col("start").alias("first"), F.least(F.col("start") + size - 1, F.col("last")).alias("last"))


def sampled_pages(ranges: DataFrame, most: int = 20) -> DataFrame:
    """(doc, page): all kept pages, or ``most`` spread evenly."""
    pages = ranges.select("doc", F.explode(F.sequence("first", "last")).alias("page"))
    ordered = Window.partitionBy("doc")
    ranked = pages.withColumn("at", F.row_number().over(ordered.orderBy("page")) - 1).withColumn("n", F.count("*").over(ordered))
    wanted = F.exists(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.floor(i * F.col("n") / most) == F.col("at"))
    return ranked.where((F.col("n") <= most) | wanted).select("doc", "page")


def trailing_index(pages: DataFrame, totals: DataFrame, share: float = 0.25, lines: int = 15) -> DataFrame:
    """(doc, page): the run of index-shaped pages at the end, within the last share of the pages."""
    last = F.greatest(F.lit(1), F.floor(F.col("pages") * share).cast("int"))
    tail = totals.select("doc", "pages", F.explode(F.sequence(F.col("pages") - last + 1, "pages")).alias("page")).join(pages, ["doc", "page"], "left")
    shaped = F.coalesce(index_shaped(F.col("text"), lines), F.lit(False)).cast("int")
    run = F.min(shaped).over(Window.partitionBy("doc").orderBy(F.col("page").desc()).rowsBetween(Window.unboundedPreceding, 0))
    return tail.withColumn("run", run).where("run = 1").select("doc", "page")


def all_skipped(by_bookmark: DataFrame, by_shape: DataFrame, totals: DataFrame, late: float = 0.6) -> DataFrame:
    """(doc, page): pages skipped by bookmarks and, where none of them lies late in a document, by their shape."""
    found = totals.join(by_bookmark, "doc").where(F.col("page") > F.col("pages") * late).select("doc").distinct()
    return by_bookmark.select("doc", "page").unionByName(by_shape.join(found, "doc", "left_anti").select("doc", "page")).distinct()


def heading_sizes(headings: DataFrame, spans: DataFrame) -> DataFrame:
    """Adds size, the largest font size met in a heading's box (0 if none); both have (doc, page, l, b, r, t)."""
    h, s = headings.alias("h"), spans.alias("s")
    meets = (F.col("s.l") < F.col("h.r")) & (F.col("h.l") < F.col("s.r")) & (F.col("s.b") < F.col("h.t")) & (F.col("h.b") < F.col("s.t"))
    same = (F.col("h.doc") == F.col("s.doc")) & (F.col("h.page") == F.col("s.page"))
    own = [F.col(f"h.{c}").alias(c) for c in headings.columns]
    return h.join(s, same & meets, "left").groupBy(*own).agg(F.coalesce(F.round(F.max("s.size"), 1), F.lit(0.0)).alias("size"))


def paged_ranks(headings: DataFrame, ranks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Adds rank: that of a heading's size; one that can't be ranked comes below all; null without any ranks.

    ``headings`` has (doc, order, size), ``ranks`` (doc, size, rank) of the sizes above the body's, and
    ``candidates`` (doc, order) of the headings that lie in no figure.
    """
    last = ranks.groupBy("doc").agg((F.max("rank") + 1).alias("__below"))
    known = candidates.select("doc", "order", F.lit(True).alias("__free"))
    met = headings.join(last, "doc", "left").join(known, ["doc", "order"], "left").join(ranks.withColumnRenamed("rank", "__rank"), ["doc", "size"], "left")
    return met.withColumn("rank", F.coalesce(F.when(F.col("__free"), F.col("__rank")), F.col("__below"))).drop("__below", "__free", "__rank")


def declared_ranks(items: DataFrame, hops: int = 32) -> DataFrame:
    """(doc, ref, rank): headings above an item along its declared parents; without a known parent, its level.

    ``items`` has (doc, ref, parent, is_heading, level); a parent '#/body' ends the walk with what was counted.
    """
    up = items.select("doc", F.col("ref").alias("__at"), F.col("parent").alias("__up"), F.col("is_heading").alias("__head"))
    now = items.select("doc", "ref", "level", F.col("parent").alias("__at"), F.lit(0).alias("__n"), F.lit(False).alias("__done"))
    for _ in range(hops):
        met = now.join(up, ["doc", "__at"], "left")
        step = met.select("doc", "ref", "level", F.coalesce("__up", F.lit("#/body")).alias("__at"), (F.col("__n") + F.coalesce(F.col("__head").cast("int"), F.lit(0))).alias("__n"), (F.col("__done") | F.col("__up").isNull()).alias("__done"))
        now = cut(step)
        if not now.where("not __done and __at <> '#/body'").limit(1).count():
            break
    own = items.select("doc", "ref", F.col("parent").isNotNull().alias("__has"))
    return now.join(own, ["doc", "ref"]).select("doc", "ref", F.when(F.col("__has"), F.col("__n")).otherwise(F.col("level")).alias("rank"))


def font_ranks(spans: DataFrame) -> DataFrame:
    """(doc, size, rank): sizes above the body's, largest first; the body is the size with most characters."""
    sized = spans.groupBy("doc", F.round("size", 1).alias("size")).agg(F.sum("chars").alias("chars"))
    body = sized.groupBy("doc").agg(F.max_by("size", F.struct("chars", -F.col("size"))).alias("body"))
    above = sized.join(body, "doc").where("size > body")
    return above.select("doc", "size", (F.dense_rank().over(Window.partitionBy("doc").orderBy(F.col("size").desc())) - 1).alias("rank"))


def outside_figures(headings: DataFrame, figures: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Headings that lie in no earlier figure of their page; both have (doc, page, order, l, t, r, b)."""
    h, f, d = headings.alias("h"), figures.alias("f"), tolerance
    inside = (F.col("f.l") - d <= F.col("h.l")) & (F.col("h.r") <= F.col("f.r") + d) & (F.col("f.b") - d <= F.col("h.b")) & (F.col("h.t") <= F.col("f.t") + d)
    same = (F.col("h.doc") == F.col("f.doc")) & (F.col("h.page") == F.col("f.page")) & (F.col("f.order") < F.col("h.order"))
    return h.join(f, same & inside, "left_anti")
