"""Registration of queries and small helpers for their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from estrato.workload.standins import STANDINS


class Tables:
    """The given tables as attributes, the stand-in tables by ``standin``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._schemas: dict[str, T.StructType] = {}

    def __getattr__(self, name: str) -> DataFrame:
        return self._read(name)

    def _read(self, name: str) -> DataFrame:
        """A table; reading it again does not look into the files again for its schema."""
        path = f"{self.folder}/{name}.parquet"
        if name in self._schemas:
            return self.spark.read.schema(self._schemas[name]).parquet(path)
        out = self.spark.read.parquet(path)
        self._schemas[name] = out.schema
        return out

    def standin(self, name: str) -> DataFrame:
        source, columns, condition = STANDINS[name]
        rows = self._read(source)
        if condition:
            rows = rows.filter(condition)
        return rows.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with its SQL twin if there is one."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = function
        if sql is not None:
            _ORACLES[name] = sql
        return function

    return register


def runnable() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function):
        return lambda spark, folder: function(Tables(spark, folder))

    return {name: bound(function) for name, function in _QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


# --- SQL text helpers ----------------------------------------------------------


def raw(name: str) -> str:
    """CTE ``name`` with the rows of a stand-in table."""
    source, columns, condition = STANDINS[name]
    where = f" WHERE {condition}" if condition else ""
    return f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source}{where})"


def rounded(value: str, scale: int) -> str:
    """Half-up rounding of the shortest decimal text of a double, once."""
    return f"CAST(CAST(CAST(CAST(({value}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,{scale})) AS DOUBLE)"


def mean(value: str, scale: int) -> str:
    """Mean of the shortest decimals of doubles, rounded once."""
    total = f"CAST(sum(CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE)"
    return rounded(f"{total} / count({value})", scale)


def summed(value: str, scale: int = 2, condition: str = "") -> str:
    """Sum in decimals, as a double."""
    keep = f" FILTER ({condition})" if condition else ""
    return f"CAST(ROUND(SUM(CAST(({value}) AS DECIMAL(38,15))){keep}, {scale}) AS DOUBLE)"


def pct(part: str, whole: str, scale: int = 2) -> str:
    return rounded(f"CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100", scale)


def best_row(source: str, columns, keys, order) -> str:
    """SELECT of the greatest row per key, ties broken by the other columns in order."""
    ranked = [*order, *[c for c in columns if c not in keys and c not in order]]
    by = ", ".join(f"{c} DESC NULLS LAST" for c in ranked)
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {by}) AS rn FROM {source}) WHERE rn = 1"
    )
