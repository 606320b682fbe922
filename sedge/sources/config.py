"""The list of sources: validated settings, file names to leave out, routes by type."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_matter, normal_title
from ..html.clean import Options, Profile

NAME, KINDS, CLEANED = re.compile(r"[a-z][a-z0-9_]*\Z"), ("pdf", "html", "md"), ("html",)


@dataclass(frozen=True)
class Source:
    """A source: where its files are, how they are read, which are left out by name."""

    name: str
    glob: str
    type: str
    cleaning: Options = field(default_factory=Options)
    skip_front_back_matter: bool = True
    extra_skip_titles: tuple[str, ...] = ()

    def __post_init__(self):
        if not NAME.match(self.name):
            raise ValueError(f"not a source's name: {self.name!r}")
        if self.type not in KINDS:
            raise ValueError(f"{self.name}: the type must be one of {', '.join(KINDS)}")
        for p in self.cleaning.profiles:
            if not NAME.match(p.name):
                raise ValueError(f"{self.name}: not a profile's name: {p.name!r}")

    @property
    def needs_cleaning(self) -> bool:
        return self.type in CLEANED

    def is_ignored(self, path: Column) -> Column:
        """Whether a file's name is that of front or back matter, by the default titles and the source's own."""
        if not self.skip_front_back_matter:
            return F.lit(False)
        stem = F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")
        own = F.lit(False)
        for title in self.extra_skip_titles:
            own = own | (normal_title(stem) == normal_title(F.lit(title)))
        return is_matter(stem) | own


def sources(text: str) -> list[Source]:
    """Sources from JSON or, where a reader for it is installed, YAML; a name that occurs twice is an error."""
    try:
        spec = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise ValueError("the list of sources is not JSON, and no reader for YAML is installed") from e
        spec = yaml.safe_load(text)
    found = []
    for entry in spec["sources"]:
        entry = dict(entry)
        options = dict(entry.pop("cleaning", None) or {})
        options["profiles"] = tuple(Profile(**{**p, "strip": tuple(p.get("strip", ()))}) for p in options.get("profiles", ()))
        options["extra_remove_selectors"] = tuple(options.get("extra_remove_selectors", ()))
        entry["extra_skip_titles"] = tuple(entry.get("extra_skip_titles", ()))
        found.append(Source(**entry, cleaning=Options(**options)))
    twice = sorted({s.name for s in found if sum(o.name == s.name for o in found) > 1})
    if twice:
        raise ValueError(f"sources of the same name: {', '.join(twice)}")
    return found


def load(path: str) -> list[Source]:
    return sources(Path(path).read_text(encoding="utf-8"))


def partitions(files: DataFrame, source: Source) -> DataFrame:
    """A source's files that are kept, with partition_key and run_key; files has (path, modified)."""
    kept = files.where(~source.is_ignored(F.col("path")))
    return kept.withColumn("partition_key", F.col("path")).withColumn("run_key", F.concat_ws("_", F.lit(source.name), "path", F.col("modified").cast("string")))


def ignored(files: DataFrame, source: Source) -> DataFrame:
    """What ``partitions`` leaves out."""
    return files.where(source.is_ignored(F.col("path")))


def routed(files: DataFrame, kind: Column) -> DataFrame:
    """Adds route: 'clean' for types that are cleaned first, else 'extract'."""
    return files.withColumn("route", F.when(kind.isin(*CLEANED), "clean").otherwise("extract"))


def cursor(text: str | None) -> dict[str, float]:
    """Times by partition key; a cursor that can't be read begins anew."""
    try:
        found = json.loads(text or "{}")
    except ValueError:
        return {}
    return {str(k): float(v) for k, v in found.items()} if isinstance(found, dict) else {}
