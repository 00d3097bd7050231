"""Scalar extraction from JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_scalar(text: Column, field: str) -> Column:
    """Value of a top-level scalar field as text.

    Objects, arrays, JSON nulls and malformed text give NULL. The type of the
    value is only looked up when its text could be an object or an array.
    """
    path = f"$.{field}"
    value = F.get_json_object(text, path)
    nested = F.try_variant_get(F.try_parse_json(text), path, "variant")
    is_nested = F.schema_of_variant(nested).rlike("^(OBJECT|ARRAY)")
    return F.when(~value.rlike(r"^[\[{]") | ~is_nested, value)
