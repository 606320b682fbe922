"""Folds over arrays within the JVM: a value bound once, and a scan with a state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], state: str, out: str, block: int = 256) -> Column:
    """array<out>: for each element in order ``step(state, element)`` gives the next state and a result.

    Results are gathered block by block, as an array that is appended to is copied each time.  A null
    array gives null, an empty one an empty array.
    """
    none = F.array().cast(f"array<{out}>")
    pair = f"struct<state:{state},out:array<{out}>>"

    def one(acc: Column, x: Column) -> Column:
        return let(F.struct(*(c.alias(n) for c, n in zip(step(acc["state"], x), ("s", "o"), strict=True))), lambda r: F.struct(r["s"].cast(state).alias("state"), F.array_append(acc["out"], r["o"].cast(out)).alias("out")).cast(pair))

    def within(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")).cast(pair), one)
        return let(done, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")).cast(pair))

    def over(a: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / block).cast("int")), lambda k: F.slice(a, k * block + 1, F.lit(block)))
        return F.when(F.size(a) > 0, F.aggregate(parts, F.struct(start.cast(state).alias("state"), none.alias("out")).cast(pair), within, lambda acc: acc["out"])).otherwise(F.when(a.isNotNull(), none))

    return let(items, over)
