"""Canonical JSON, content hashes and readings of VARIANT values.

A VARIANT object prints with sorted keys at every level, so ``to_json`` of a VARIANT
is already a canonical form. A struct whose fields are in name order prints the same
bytes, which saves a parse when the schema is known.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.text import is_blank

# Bookkeeping keys of `content` that are no part of the body.
VOLATILE_KEYS = ["bodySource", "fetchedAt"]
ERROR_KEY = "bodyError"
# Keys that a body extraction writes and a new one clears.
STALE_KEYS = ["sections", "body_text", "bodyError", "bodySource", "fetchedAt"]
# Body keys, current and legacy.
BODY_KEYS = ["body_text", "bodyText"]


def as_map(v: Column) -> Column:
    """VARIANT object as a map; a null object becomes an empty map."""
    return F.coalesce(v.cast("map<string,variant>"), F.create_map().cast("map<string,variant>"))


def as_object(m: Column) -> Column:
    return F.call_function("to_variant_object", m)


def canonical_json(v: Column) -> Column:
    return F.coalesce(F.to_json(v), F.lit("{}"))


def canonical_hash(v: Column) -> Column:
    """SHA-256 of the canonical JSON of a VARIANT."""
    return F.sha2(canonical_json(v), 256)


def sorted_struct_hash(**fields: Column) -> Column:
    """The same hash for a value whose top-level fields are known; null fields are left out."""
    ordered = [fields[name].alias(name) for name in sorted(fields)]
    return F.sha2(F.to_json(F.struct(*ordered)), 256)


def without_keys(v: Column, keys: list[str]) -> Column:
    return as_object(F.map_filter(as_map(v), lambda k, _: ~k.isin(keys)))


def content_hash(content: Column) -> Column:
    """Hash of the body alone, so that a new fetch time is no change."""
    return canonical_hash(without_keys(content, VOLATILE_KEYS))


@F.pandas_udf(StringType())
def ascii_hash(texts: pd.Series) -> pd.Series:
    """Hash over JSON text with non-ASCII escaped as ``\\uXXXX`` and floats kept as written.

    Only needed to match hashes that another writer made in that form; the native
    ``canonical_hash`` is the default.
    """

    def digest(text):
        if text is None:
            return None
        form = json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"))
        return hashlib.sha256(form.encode("utf-8")).hexdigest()

    return texts.map(digest)


# VARIANT schema names and the JSON type each stands for.
TYPE_NAMES = {
    "VOID": "null", "BOOLEAN": "boolean", "STRING": "string", "ARRAY": "list", "OBJECT": "object",
    "TINYINT": "number", "SMALLINT": "number", "INT": "number", "BIGINT": "number", "FLOAT": "number",
    "DOUBLE": "number", "DECIMAL": "number",
}


def type_name(v: Column) -> Column:
    """One of null, boolean, number, string, list, object."""
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    # The schema is printed once per value and looked up, instead of once per CASE branch.
    head = F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1)
    return F.coalesce(F.element_at(names, head), F.lower(head), F.lit("null"))


def is_object(v: Column) -> Column:
    """Cheaper than ``type_name``, which prints the schema of everything below."""
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def field(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$['{key}']", "variant")


def text_field(v: Column, key: str) -> Column:
    """The value under ``key`` if it is a string, else null. Nothing is cast to a string."""
    f = field(v, key)
    return F.when(F.schema_of_variant(f) == "STRING", F.try_variant_get(f, "$", "string"))


def number_field(v: Column, key: str) -> Column:
    """The value under ``key`` as a whole number if it is a number; numeric strings are rejected."""
    f = field(v, key)
    number = F.when(type_name(f) == "number", F.try_variant_get(f, "$", "double"))
    exact = F.when(F.schema_of_variant(f) == "BIGINT", F.try_variant_get(f, "$", "bigint"))
    return F.coalesce(exact, number.cast("bigint"))


def body_text(content: Column) -> Column:
    """Body under the current or the legacy key, string values only."""
    return F.coalesce(*[text_field(content, key) for key in BODY_KEYS])


def consumer_body(content: Column, html_field: Column) -> Column:
    """What a consumer indexes: the extracted body, else the HTML field its type names."""
    entries = as_map(content)
    html = F.try_variant_get(F.element_at(entries, html_field), "$", "string")
    own = text_field(content, "body_text")
    return F.coalesce(F.when(~is_blank(own), own), html)


def has_body(content: Column) -> Column:
    """True when any key but the bookkeeping ones and the error holds a value.

    Blank strings and nulls hold none; an empty object or list does.
    """
    skip = VOLATILE_KEYS + [ERROR_KEY]
    return F.exists(
        F.map_entries(as_map(content)),
        lambda e: ~e["key"].isin(skip)
        & (type_name(e["value"]) != "null")
        & (
            (F.schema_of_variant(e["value"]) != "STRING")
            | ~is_blank(F.try_variant_get(e["value"], "$", "string"))
        ),
    )


def body_settled(content: Column) -> Column:
    """True when a fetch is not due: a body is there, or an earlier fetch failed for good."""
    body = text_field(content, "body_text")
    return F.coalesce(~is_blank(body), F.lit(False)) | text_field(content, ERROR_KEY).isNotNull()


# Keys under which a state document may keep its list of held rows.
HELD_KEYS = ["held", "holds", "entries", "ids"]


def held_list(v: Column) -> Column:
    """The document itself if it is a list, else the first list under one of four keys, else empty."""
    as_list = lambda x: F.try_variant_get(x, "$", "array<variant>")
    empty = F.array().cast("array<variant>")
    return F.coalesce(as_list(v), *[as_list(field(v, key)) for key in HELD_KEYS], empty)
