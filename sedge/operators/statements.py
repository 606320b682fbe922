"""Graph tables as insert statements: literals, values, batches of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folds import scan

#: A statement's limits, and two bytes that part its values.
MOST_VALUES, MOST_BYTES, PART = 200, 262_144, 2


def escaped(value: Column) -> Column:
    """Backslashes first, then double quotes and control characters; apostrophes stay."""
    for sign, told in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        value = F.replace(value, F.lit(sign), F.lit(told))
    return value


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), escaped(value), F.lit('"'))


def literal(df: DataFrame, name: str) -> Column:
    """A column as a literal by its type; null is an empty string."""
    kind, c = dict(df.dtypes)[name], F.col(f"`{name}`")
    return F.coalesce(quoted(c) if kind == "string" else c.cast("string"), F.lit('""'))


def vertex_values(vertices: DataFrame, vid: str = "vid", properties: tuple[str, ...] = ("label", "page_no", "text", "minio_url"), tag: str = "tag", more: tuple[str, ...] = ()) -> DataFrame:
    """(*more, kind, key, value): the VALUES expression of each vertex."""
    inside = F.concat_ws(", ", *[literal(vertices, p) for p in properties])
    return vertices.select(*more, F.col(tag).alias("kind"), F.col(vid).alias("key"), F.concat(quoted(F.col(vid)), F.lit(":("), inside, F.lit(")")).alias("value"))


def edge_values(edges: DataFrame, of: dict[str, str] | None = None) -> DataFrame:
    """(kind, key, value): the VALUES expression of each edge; ``of`` names each type's property."""
    of = of or {"PARENT_OF": "sequence", "LINKED_TO": "relation"}
    inside = F.coalesce(*[F.when(F.col("edge_type") == k, literal(edges, p)) for k, p in of.items()])
    ends = F.concat(quoted(F.col("src")), F.lit(" -> "), quoted(F.col("dst")))
    return edges.select(F.col("edge_type").alias("kind"), F.concat_ws(">", "src", "dst").alias("key"), F.concat(ends, F.lit(":("), inside, F.lit(")")).alias("value"))


def batched(values: DataFrame, by: list[str], most_values: int = MOST_VALUES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(*by, kind, batch, statement values): neighbours (by key) gathered up to a number and a weight.

    ``by`` names what a task's share is, such as the document; a value over the weight is a batch of its own.
    """
    state = "struct<batch:int,n:int,weight:long>"

    def step(s: Column, x: Column) -> tuple[Column, Column]:
        weight = (F.octet_length(x["value"]) + PART).cast("long")
        full = (s["n"] >= most_values) | (s["weight"] + weight > most_bytes)
        new = (s["n"] > 0) & full
        batch = F.when(new, s["batch"] + 1).otherwise(s["batch"])
        n, held = F.when(new, 1).otherwise(s["n"] + 1), F.when(new, weight).otherwise(s["weight"] + weight)
        return F.struct(batch.alias("batch"), n.alias("n"), held.alias("weight")), F.struct(batch.alias("batch"), x["key"].alias("key"), x["value"].alias("value"))

    start = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("weight"))
    rows = values.groupBy(*by, "kind").agg(F.array_sort(F.collect_list(F.struct("key", "value"))).alias("v"))
    placed = rows.select(*by, "kind", F.inline(scan(F.col("v"), start, step, state, "struct<batch:int,key:string,value:string>")))
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "value"))), lambda x: x["value"]), ", ")
    return placed.groupBy(*by, "kind", "batch").agg(F.count("*").alias("n"), told.alias("values"))


def inserts(batches: DataFrame, what: str, properties: dict[str, str]) -> DataFrame:
    """Adds the statement of each batch; ``what`` is VERTEX or EDGE, ``properties`` the names of each kind."""
    names = F.element_at(F.create_map(*[F.lit(x) for kv in properties.items() for x in kv]), F.col("kind"))
    return batches.withColumn("statement", F.concat(F.lit(f"INSERT {what} "), "kind", F.lit("("), names, F.lit(") VALUES "), "values", F.lit(";")))


def schema_statements(tags: list[str]) -> list[str]:
    """Statements that make the graph's schema; each may be run again."""
    document = "filename string, type_file string, total_pages int, collection string, source_path string, language string, content_hash string"
    return [
        f"CREATE TAG IF NOT EXISTS Document({document});",
        *[f"CREATE TAG IF NOT EXISTS {t}(label string, page_no int, text string, minio_url string);" for t in sorted(set(tags))],
        "CREATE EDGE IF NOT EXISTS PARENT_OF(sequence int);",
        "CREATE EDGE IF NOT EXISTS LINKED_TO(relation string);",
    ]

