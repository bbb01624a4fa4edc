"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_text(value: Column) -> Column:
    """True for text that is neither NULL nor blank."""
    return F.coalesce(F.trim(value) != "", F.lit(False))


def split_name(name: Column, separator: str = ", ") -> tuple[Column, Column]:
    """``"Last, First"`` as (last, first); first is NULL without a separator."""
    parts = F.split(F.trim(name), separator)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def join_text(*parts: Column, separator: str = ", ") -> Column:
    """Parts joined as text; a missing part keeps its place as an empty text."""
    return F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def file_name(path: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)


def file_label(name: Column) -> Column:
    """Text before the first underscore; the whole name if there is none."""
    return F.substring_index(name, "_", 1)


def file_extension(name: Column) -> Column:
    """Lower-case extension without the dot; empty if there is none."""
    return F.lower(F.regexp_extract(name, r"\.(\w+)$", 1))
