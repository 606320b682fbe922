"""Media: inline data, object names, types, and the geometry of crops."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Extensions of image types and types of image files.
EXTENSIONS = {"image/png": "png", "image/jpeg": "jpg", "image/gif": "gif", "image/webp": "webp", "image/svg+xml": "svg", "image/avif": "avif"}
CONTENT_TYPES = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".gif": "image/gif", ".webp": "image/webp", ".svg": "image/svg+xml", ".avif": "image/avif", ".bmp": "image/bmp"}


def _of(values: dict[str, str], key: Column, other: str) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.lower(key)), F.lit(other))


def extension(content_type: Column) -> Column:
    return _of(EXTENSIONS, content_type, "bin")


def content_type(path: Column) -> Column:
    return _of(CONTENT_TYPES, F.regexp_extract(path, r"\.[^./]+$", 0), "application/octet-stream")


def data_uri(value: Column) -> Column:
    """struct<content_type, payload> of a base64 data URI, null if it is none or is damaged."""
    head, body = F.substring_index(value, ",", 1), F.regexp_replace(F.substring(value, F.instr(value, ",") + 1, F.length(value)), r"\s", "")
    kind = F.coalesce(F.nullif(F.regexp_extract(head, r"^data:([^;]*)", 1), F.lit("")), F.lit("application/octet-stream"))
    good = value.startswith("data:") & head.contains(";base64") & (F.instr(value, ",") > 0) & (body != "") & body.rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$")
    return F.when(good, F.struct(kind.alias("content_type"), F.try_to_binary(body, F.lit("base64")).alias("payload")))


def html_image(key: Column, index: Column, kind: Column) -> Column:
    """Object name of an image that was taken out of a page."""
    from .pages import object_key

    return F.concat(F.lit("images/html/"), object_key(key), F.lit("/img_"), F.lpad(index.cast("string"), 4, "0"), F.lit("."), extension(kind))


def attachment(key: Column, index: Column, name: Column) -> Column:
    """Object name of a file that a note refers to."""
    from .pages import object_key

    return F.concat(F.lit("images/md/"), object_key(key, dots=True), F.lit("/"), F.lpad(index.cast("string"), 4, "0"), F.lit("_"), object_key(name, dots=True))


def object_url(base: str, name: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), name)


def crop(l: Column, t: Column, r: Column, b: Column, width: Column, height: Column, least: float = 1.0) -> Column:  # noqa: E741
    """struct<x0, y0, x1, y1> of a box, measured from the page's top and clipped to it; null if under a point.

    A box whose top is above its bottom number is measured from the page's foot and is turned over.
    """
    up = t > b
    y0, y1 = F.when(up, height - t).otherwise(t), F.when(up, height - b).otherwise(b)
    zero = F.lit(0.0)
    box = [F.greatest(zero, F.least(l, r)), F.greatest(zero, F.least(y0, y1)), F.least(width, F.greatest(l, r)), F.least(height, F.greatest(y0, y1))]
    return F.when((box[2] - box[0] >= least) & (box[3] - box[1] >= least), F.struct(*[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)]))


def rounded(box: Column, names: tuple[str, ...] = ("l", "t", "r", "b"), digits: int = 2) -> Column:
    """A box with all sides to two decimals, null where there is none."""
    return F.when(box.isNotNull(), F.struct(*[F.round(box[n], digits).alias(n) for n in names]))
