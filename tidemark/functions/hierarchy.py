"""Structure kept inside strings: pipe paths, comma lists and nested JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

APPLIES_TO = "array<struct<Product:string,Versions:array<string>>>"


def path_levels(c: Column, depth: int) -> list[Column]:
    """The first ``depth`` parts of ``A|17|17.1``; missing parts are null."""
    parts = F.split(c, r"\|")
    return [F.get(parts, F.lit(i)) for i in range(depth)]


def path_prefixes(c: Column) -> Column:
    """Every ancestor of a pipe path and the path itself, the form multi-valued tags are stored in."""
    parts = F.split(c, r"\|")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "|"))


def comma_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def applies_to(c: Column) -> Column:
    """Parse the JSON string of products and versions; unreadable text gives null."""
    return F.from_json(c, APPLIES_TO)
