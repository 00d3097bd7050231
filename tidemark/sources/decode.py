"""Lenient JSON decoding of a text log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_CORRUPT = "_corrupt"


def _decoded(raw: DataFrame, fields: Sequence[str], value: str, keep: Sequence[str]) -> DataFrame:
    """The text and its record. A generator makes both, so a filter on a field
    stays above it instead of parsing the text again."""
    schema = ", ".join(f"`{f}` STRING" for f in (*fields, _CORRUPT))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.struct(F.col(value).alias("_text"), F.from_json(value, schema, options).alias("_record"))
    return raw.select(*keep, F.inline(F.array(parsed)))


def _readable(fields: Sequence[str]) -> Column:
    """False where the parser gave up on all of a record, true for a single bad field.

    The record is compared as a whole: a condition on every field by name would
    multiply the constraints Spark derives for the renamed fields.
    """
    none = ", ".join(f"'{f}', CAST(NULL AS STRING)" for f in fields)
    nothing = f"_record <=> named_struct({none}, '{_CORRUPT}', _record.{_CORRUPT})"
    return F.expr(f"_record IS NOT NULL AND (_record.{_CORRUPT} IS NULL OR NOT ({nothing}))")


def decode(raw: DataFrame, fields: Sequence[str], value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Records that could be read, every field as text.

    A missing field is NULL. A nested object keeps its JSON text. ``keep``
    names columns of ``raw`` to carry along, such as the log offset.
    """
    records = _decoded(raw, fields, value, keep).where(_readable(fields))
    return records.select(*keep, "_record.*").drop(_CORRUPT)


def undecodable(raw: DataFrame, fields: Sequence[str], value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The complement of ``decode``: the original text of what could not be read."""
    return (
        _decoded(raw, fields, value, keep)
        .where(~_readable(fields))
        .select(*keep, F.col("_text").alias(value), F.lit("unparseable").alias("reason"))
    )


def rejects(
    raw: DataFrame, fields: Sequence[str], field: str, known: Sequence[str], other: str, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """What ``undecodable`` gives, and records whose ``field`` is not one of ``known``, for the reason ``other``; parsed once."""
    whole = F.expr(f"_record.{_CORRUPT} IS NULL OR _record.{field} IS NOT NULL")
    unknown = whole & ~F.coalesce(F.col(f"_record.{field}").isin(*known), F.lit(False))
    reason = F.when(~_readable(fields), "unparseable").when(unknown, other)
    # The reason is made by a generator too, or the filter would parse the text again.
    found = _decoded(raw, fields, value, keep).select(*keep, F.col("_text").alias(value), F.explode(F.array(reason)).alias("reason"))
    return found.where("reason IS NOT NULL")
