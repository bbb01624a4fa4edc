"""Projection, type conforming and row checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.functions.text import has_text


def conform(df: DataFrame, types: dict[str, str], keep_rest: bool = True, optional: Sequence[str] = ()) -> DataFrame:
    """Bring columns to declared types in one projection.

    A value that does not convert becomes NULL.  A declared column that is absent
    raises ``ValueError``, unless it is ``optional``: then it is a NULL column.
    Names match without regard to case.  Undeclared columns stay behind the
    declared ones unless ``keep_rest`` is off.
    """
    present = {c.lower(): c for c in df.columns}
    declared = {c.lower() for c in types}
    absent = declared - present.keys() - {c.lower() for c in optional}
    if absent:
        raise ValueError(f"declared columns are absent: {', '.join(sorted(absent))}")
    out = [
        (F.col(f"`{present[c.lower()]}`").try_cast(t) if c.lower() in present else F.lit(None).cast(t)).alias(c)
        for c, t in types.items()
    ]
    if keep_rest:
        out += [F.col(f"`{c}`") for c in df.columns if c.lower() not in declared]
    return df.select(*out)


def role(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Columns under the names of one of their roles: ``{new: old}``."""
    return df.select(*[F.col(old).alias(new) for new, old in mapping.items()])


def require(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which none of the keys is missing."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def require_text(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all of the columns hold more than blanks."""
    return df.filter(reduce(lambda a, b: a & b, [has_text(F.col(c)) for c in columns]))


def ordered(start: str, end: str) -> Column:
    """Start not after end; NULL, so not met, if one is missing."""
    return F.col(start) <= F.col(end)


def in_range(column: str, low, high) -> Column:
    """Closed range; NULL and NaN are outside."""
    return F.col(column).between(low, high)


@dataclass(frozen=True)
class Check:
    """Named condition a row has to meet; a NULL outcome counts as not met."""

    name: str
    condition: str

    @property
    def met(self) -> Column:
        return F.expr(self.condition)

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.met, F.lit(False))


def keep_valid(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows that meet all checks; a plain filter, so it can reach the scan."""
    return df.filter(reduce(lambda a, b: a & b, [c.met for c in checks]))


def tag_rejects(df: DataFrame, checks: Sequence[Check], column: str = "rejected_by") -> DataFrame:
    """Add the names of the broken checks, comma separated; empty for valid rows.

    Valid and quarantined rows are the two filters on this column, together
    exactly the input.
    """
    names = [F.when(c.broken, F.lit(c.name)) for c in checks]
    return df.withColumn(column, F.concat_ws(",", *names))
