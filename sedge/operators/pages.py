"""Pages to cleaned content, titles and plain text."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..html.clean import Options, clean

CLEANED = "page_id long, html string, strategy string, title string, text string, raw_bytes long, precleaned_bytes long, cleaned_bytes long, text_chars long, images array<struct<index:int,object_key:string,content_type:string,payload:binary>>, error string"

#: Named character references that titles are read with.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def clean_pages(df: DataFrame, options: Options = Options(), id_col: str = "page_id", html_col: str = "html", key_col: str | None = None) -> DataFrame:
    """Each page's main content, report and images; one narrow Arrow pass, a page at a time in memory.

    Bytes that are no UTF-8 are ignored; a null page counts as empty; a page that can't be cleaned keeps its
    row, with the reason in ``error``.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [f.split(" ")[0] for f in CLEANED.split(", ")]
        image = pa.struct([("index", pa.int32()), ("object_key", pa.string()), ("content_type", pa.string()), ("payload", pa.binary())])
        kinds = [pa.int64()] + [pa.string()] * 4 + [pa.int64()] * 4 + [pa.list_(image), pa.string()]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for page, raw, key in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    text = raw.decode("utf-8", "ignore") if isinstance(raw, bytes) else raw or ""
                    try:
                        c = clean(text, options, key or str(page))
                        images = [dict(zip(("index", "object_key", "content_type", "payload"), i, strict=True)) for i in c.images]
                        rows.append((page, c.html, c.strategy, c.title, c.text, c.raw_bytes, c.precleaned_bytes, c.cleaned_bytes, c.text_chars, images, None))
                    except Exception as e:  # one page's failure is its row's, not the job's
                        rows.append((page, None, None, None, None, len(text.encode()), None, None, None, [], f"{type(e).__name__}: {e}"))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    key = F.lit(None).cast("string") if key_col is None else F.col(key_col)
    return df.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"), key.alias("key")).mapInArrow(run, CLEANED)


def media(cleaned: DataFrame) -> DataFrame:
    """(object_key, content_type, payload) of the images that cleaning took out of pages."""
    return cleaned.select(F.inline("images")).select("object_key", "content_type", "payload")


def unescaped(text: Column) -> Column:
    """Text with the common character references resolved."""
    for name, sign in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def title_of(html: Column) -> Column:
    """A page's title without the site's name, within the JVM."""
    whole = F.trim(unescaped(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<title[^>]*>([^<]{1,300})</title>", 1)))
    parts = F.split(whole, r"\s+[-–—|·»]\s+", -1)
    return F.when(F.size(parts) > 1, F.trim(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), " "))).otherwise(whole)


def with_title(html: Column, title: Column) -> Column:
    """The title as a first heading, if there is one and the page has none."""
    escaped = F.replace(F.replace(F.replace(title, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.when((F.coalesce(title, F.lit("")) == "") | html.rlike(r"(?i)<h1[\s>]"), html).otherwise(F.concat(F.lit("<h1>"), escaped, F.lit("</h1>\n"), html))


def plain_text(html: Column) -> Column:
    """Visible text by patterns alone: scripts, styles and comments go, tags become blanks."""
    kept = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(kept, r"<[^>]*>", " ")), r"[ \t\r\n\x0b\f]+", " "))


def object_key(key: Column, dots: bool = False) -> Column:
    """A key that is safe in object names; attachments keep their dots."""
    return F.regexp_replace(F.regexp_replace(key, r"[^A-Za-z0-9/_.-]+" if dots else r"[^A-Za-z0-9/_-]+", "_"), r"^[/_]+|[/_]+$", "")


def mirrored(key: Column, folder: str = ".cleaned") -> Column:
    """Where a page's cleaned form goes: its own path below ``folder``, which its identity leaves out again."""
    return F.concat(F.lit(folder + "/"), F.ltrim(F.replace(key, F.lit("\\"), F.lit("/")), F.lit("/")))


def write_mirror(cleaned: DataFrame, target: str, key_col: str = "partition_key", html_col: str = "html") -> None:
    """Cleaned pages as a table (path, html) whose paths mirror the tree; writing it again replaces it."""
    cleaned.select(mirrored(F.col(key_col)).alias("path"), F.col(html_col).alias("html")).write.mode("overwrite").parquet(target)
