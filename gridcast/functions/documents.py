"""JSON text columns: tolerant reading, strict writing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridcast.functions.coerce import finite


def text_list(column: str, default: list[str]) -> Column:
    """List of strings from a JSON array; anything else gives `default`."""
    fallback = F.array(*[F.lit(item) for item in default]) if default else F.array().cast("array<string>")
    text = F.trim(F.col(column))
    parsed = F.from_json(text, "array<string>")
    return F.when(F.coalesce(F.get_json_object(text, "$[*]").isNotNull() | (F.json_array_length(text) >= 0),
                             F.lit(False)), F.coalesce(parsed, fallback)).otherwise(fallback)


def text_field(column: str, name: str) -> Column:
    """One field of a JSON object as text; null for anything that is not an object."""
    text = F.trim(F.col(column))
    return F.when(F.json_object_keys(text).isNotNull(), F.get_json_object(text, f"$.{name}"))


def object_text(fields: dict[str, Column], floats=()) -> Column:
    """JSON object with its keys in name order; non-finite numbers become null."""
    parts = [
        (F.when(finite(value), value) if name in floats else value).alias(name)
        for name, value in sorted(fields.items())
    ]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
