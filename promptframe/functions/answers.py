"""JSON text of unknown shape as variant columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_whole(text: Column | str) -> Column:
    """Variant of a text that is exactly one JSON value, else null.

    The text is the first of two elements of an array; the second is the text's
    own hash, which no text can hold, so whatever follows its value moves or
    hides that mark and is refused.
    """
    text = F.col(text) if isinstance(text, str) else text
    mark = F.sha2(text, 256)
    boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    whole = F.try_variant_get(boxed, "$[1]", "string") == mark
    return F.when(whole, F.try_variant_get(boxed, "$[0]", "variant"))


def member(value: Column, key: str) -> Column:
    """Member of an object as variant; null only where the key is missing."""
    quote = '"' if "'" in key else "'"
    return F.try_variant_get(value, f"$[{quote}{key}{quote}]", "variant")


def kind(value: Column) -> Column:
    """Schema text of a variant, for example ``BIGINT`` or ``OBJECT<..>``."""
    return F.schema_of_variant(value)


def as_string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def keys_of(value: Column) -> Column:
    """Key names of an object variant, null for anything else."""
    return F.json_object_keys(F.to_json(value))


def cell_text(value: Column) -> Column:
    """Scalar as text, list or object as JSON text, JSON null as null."""
    nested = kind(value).startswith("ARRAY") | kind(value).startswith("OBJECT")
    return F.when(nested, F.to_json(value)).when(~F.is_variant_null(value), as_string(value))
