"""Markdown: fences, images as lines of their own, paragraphs put together; all within the JVM.

A text's lines are one array; only the fence's state and the images' numbers are carried along (``scan``),
everything else looks at a line and its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folds import let, scan

#: The syntax.
NEWLINES = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
FENCE = r"^\s{0,3}(`{3,}|~{3,})"
STARTERS = r"^(?:\s{0,3}(?:#{1,6}(?:\s|$)|[-*+]\s|\d+[.)]\s|>|\||(?:[-*_]\s*){3,}$|<)|(?:\t| {4,})\S|⟦IMG:\d{4}⟧)"
UNDERLINE = r"^\s{0,3}(?:=+|-+)\s*$"
HARD_BREAK = r"(?:\s{2,}|\\)$"
WIKI_IMAGE = r"!\[\[([^\]|]+?)(?:\|[^\]]*)?\]\]"
IMAGE = r"""!\[([^\]]*)\]\(\s*<?([^)>\s]+)>?(?:\s+"[^"]*")?\s*\)"""
MARKER = r"^⟦IMG:(\d{4})⟧\s*(.*)$"

REFERENCE = "struct<index:int,target:string,caption:string>"


def lines_of(text: Column) -> Column:
    """Lines without their ends; a last line end begins no further line."""
    return let(F.split(F.coalesce(text, F.lit("")), NEWLINES, -1), lambda a: F.when(F.get(a, F.size(a) - 1) == "", F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a))


def fenced(lines: Column) -> Column:
    """array<boolean>: lines of code fences, the fences themselves included; an open one runs to the end."""

    def step(mark: Column, line: Column) -> tuple[Column, Column]:
        own = F.left(F.regexp_extract(line, FENCE, 1), F.lit(1))
        after = F.when((own != "") & (mark == ""), own).when((own != "") & (own == mark), F.lit("")).otherwise(mark)
        return after, (own != "") | (mark != "")

    return scan(lines, F.lit(""), step, "string", "boolean")


def _stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def _ended(text: Column, done: Column) -> Column:
    """The last line end kept as it was."""
    return let(done, lambda d: F.when(F.endswith(F.coalesce(text, F.lit("")), F.lit("\n")) & ~F.endswith(d, F.lit("\n")), F.concat(d, F.lit("\n"))).otherwise(d))


def paragraphs(text: Column) -> Column:
    """The text with the lines of each paragraph put on one line."""

    def joined(lines: Column, code: Column) -> Column:
        line = lambda i: F.coalesce(F.get(lines, i), F.lit(""))

        def kinds(x: Column, i: Column) -> Column:
            prose = ~F.get(code, i) & (_stripped(x) != "") & ~x.rlike(STARTERS) & ~line(i + 1).rlike(UNDERLINE)
            return F.struct(prose.alias("prose"), (prose & ~x.rlike(HARD_BREAK)).alias("open"))

        def told(kind: Column) -> Column:
            on = lambda i: F.coalesce(F.get(kind, i)["prose"] & F.get(kind, i - 1)["open"], F.lit(False))

            def piece(x: Column, i: Column) -> Column:
                start = F.when(on(i), F.lit(" ")).when(i > 0, F.lit("\n")).otherwise("")
                own = F.when(on(i), _stripped(x)).when(on(i + 1), F.regexp_replace(x, r"(?U)\s+$", "")).otherwise(x)
                return F.concat(start, own)

            return F.array_join(F.transform(lines, piece), "")

        return let(F.transform(lines, kinds), told)

    return _ended(text, let(lines_of(text), lambda lines: let(fenced(lines), lambda code: joined(lines, code))))


def _target(raw: Column) -> Column:
    """A link's target with its %-escapes resolved, as it is if they are damaged."""
    raw = _stripped(raw)
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def _label(target: Column, caption: Column) -> Column:
    name = F.substring_index(F.replace(target, F.lit("\\"), F.lit("/")), "/", -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.when(caption != "", caption).when(stem != "", stem).otherwise(name)


def images(text: Column) -> Column:
    """struct<text, images array<struct<index, target, caption>>>: each image a line of its own in its place.

    Lines of code fences stay as they are.  On one line wiki images are numbered before the others.
    """

    def found(line: Column) -> Column:
        wiki = F.transform(F.regexp_extract_all(line, F.lit(WIKI_IMAGE), F.lit(1)), lambda t: F.struct(_target(t).alias("target"), F.lit("").alias("caption")))
        rest = F.regexp_replace(line, WIKI_IMAGE, "")
        plain = F.zip_with(F.regexp_extract_all(rest, F.lit(IMAGE), F.lit(2)), F.regexp_extract_all(rest, F.lit(IMAGE), F.lit(1)), lambda t, c: F.struct(_target(t).alias("target"), _stripped(c).alias("caption")))
        return F.struct(line.alias("line"), F.regexp_replace(rest, IMAGE, "").alias("rest"), F.concat(wiki, plain).alias("found"))

    def step(n: Column, x: Column) -> tuple[Column, Column]:
        refs = F.transform(x["found"], lambda r, k: F.struct((n + k).alias("index"), r["target"].alias("target"), r["caption"].alias("caption")))
        return n + F.size(x["found"]), F.struct(x["line"].alias("line"), x["rest"].alias("rest"), refs.alias("refs"))

    def rendered(x: Column) -> Column:
        marks = F.transform(x["refs"], lambda r: F.concat(F.lit("⟦IMG:"), F.lpad(r["index"].cast("string"), 4, "0"), F.lit("⟧ "), _label(r["target"], r["caption"])))
        own = F.when(_stripped(x["rest"]) != "", F.array(x["rest"])).otherwise(F.array().cast("array<string>"))
        return F.when(F.size(x["refs"]) == 0, F.array(x["line"])).otherwise(F.concat(own, marks))

    def told(lines: Column, code: Column) -> Column:
        plain = lambda x: F.struct(x.alias("line"), x.alias("rest"), F.array().cast("array<struct<target:string,caption:string>>").alias("found"))
        items = F.transform(lines, lambda x, i: F.when(F.get(code, i) | ~x.contains("!["), plain(x)).otherwise(found(x)))
        numbered = scan(items, F.lit(0), step, "int", f"struct<line:string,rest:string,refs:array<{REFERENCE}>>")
        return let(numbered, lambda n: F.struct(_ended(text, F.array_join(F.flatten(F.transform(n, rendered)), "\n")).alias("text"), F.flatten(F.transform(n, lambda x: x["refs"])).alias("images")))

    return let(lines_of(text), lambda lines: let(fenced(lines), lambda code: told(lines, code)))


def marked(line: Column) -> Column:
    """struct<index, caption> of an image's line, null for any other."""
    return F.when(line.rlike(MARKER), F.struct(F.regexp_extract(line, MARKER, 1).cast("int").alias("index"), F.regexp_extract(line, MARKER, 2).alias("caption")))


def with_pictures(elements: DataFrame, urls: DataFrame) -> DataFrame:
    """Elements whose text marks an image become pictures with their caption and, where it was sent, its URL.

    ``urls`` has (doc_id, index, url).
    """
    of = elements.withColumn("__m", marked(F.col("text")))
    known = urls.select("doc_id", F.col("index").alias("__i"), F.col("url").alias("__url"))
    met = of.withColumn("__i", F.col("__m.index")).join(known, ["doc_id", "__i"], "left")
    is_image = F.col("__m").isNotNull()
    return met.withColumn("label", F.when(is_image, "picture").otherwise(F.col("label"))).withColumn("text", F.when(is_image, F.col("__m.caption")).otherwise(F.col("text"))).withColumn("minio_url", F.coalesce("__url", F.lit(""))).drop("__m", "__i", "__url")


def resolved(references: DataFrame, attachments: DataFrame) -> DataFrame:
    """References (doc_id, folder, index, target) with the attachment (path) they name, null if there is none.

    A path relative to the note comes first, then any file of that name, the first by path.
    """
    direct = references.withColumn("__path", F.concat_ws("/", F.nullif("folder", F.lit("")), "target")).withColumn("__name", F.substring_index("target", "/", -1))
    files = attachments.select(F.col("path").alias("__path"), F.col("path").alias("__exact"))
    by_name = attachments.groupBy(F.substring_index("path", "/", -1).alias("__name")).agg(F.min("path").alias("__any"))
    met = direct.join(files, "__path", "left").join(by_name, "__name", "left")
    return met.withColumn("path", F.coalesce("__exact", "__any")).drop("__path", "__name", "__exact", "__any")


def image_totals(resolved_: DataFrame) -> DataFrame:
    """(doc_id, referenced, sent, missing) of a document's images."""
    return resolved_.groupBy("doc_id").agg(F.count("*").alias("referenced"), F.count("path").alias("sent"), F.count_if(F.col("path").isNull()).alias("missing"))
