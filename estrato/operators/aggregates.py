"""Grouped measures, shares and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.functions.numbers import percent, stable_mean, stable_round
from estrato.operators.exact import exact_sums
from estrato.operators.shape import require
from estrato.session import cut_lineage


def n_rows() -> Column:
    return F.count(F.lit(1))


def entity_summary(
    df: DataFrame, key: str, measures: dict[str, str], positions: dict[str, str], time: str
) -> DataFrame:
    """Per entity: rounded avg/max/min of each measure, mean position, count, first and last event.

    ``measures`` and ``positions`` are ``{suffix: column}``.
    """
    out = []
    for name, column in measures.items():
        out.append(stable_mean(F.col(column), 2).alias(f"avg_{name}"))
        out += [stable_round(f(column), 2).alias(f"{p}_{name}") for p, f in (("max", F.max), ("min", F.min))]
    out += [stable_mean(F.col(c), 6).alias(f"avg_{n}") for n, c in positions.items()]
    out += [n_rows().alias("total_events"), F.min(time).alias("first_event"), F.max(time).alias("last_event")]
    return df.groupBy(key).agg(*out)


def state_counts(column: str, states: dict[str, str]) -> list[Column]:
    """One count per state, ``{alias: value}``."""
    return [F.count_if(F.col(column) == value).alias(alias) for alias, value in states.items()]


def counts(df: DataFrame, *by: str, alias: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(n_rows().alias(alias))


def share(
    df: DataFrame,
    by: str,
    null_label: str | None = None,
    scale: int = 2,
    count: str = "n",
    pct: str = "pct",
    cut: bool = False,
) -> DataFrame:
    """Rows per group and their percentage of all rows.

    The total is a scalar subquery over the grouped counts and shares their
    shuffle.  Above joins, adaptive planning may run the two differently and
    evaluate the input twice; ``cut`` writes the counts (one row per group)
    so that a dear input is evaluated once.
    """
    column = F.col(by) if null_label is None else F.coalesce(F.col(by).cast("string"), F.lit(null_label))
    grouped = df.groupBy(column.alias(by)).agg(n_rows().alias(count))
    if cut:
        grouped = cut_lineage(grouped)
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.select(by, count, percent(F.col(count), total, scale).alias(pct))


def imbalance(df: DataFrame, by: str, floor_pct: float = 5.0) -> DataFrame:
    """Smallest share of any group and whether it is below the floor; one row."""
    return share(df, by).agg(F.min("pct").alias("min_pct")).withColumn(
        "imbalanced", F.coalesce(F.col("min_pct") < floor_pct, F.lit(False))
    )


def top_share(df: DataFrame, by: str, measure: str, k: int = 5, scale: int = 2) -> DataFrame:
    """The ``k`` groups with the largest sum, and their percentage of these k sums."""
    sums = exact_sums(require(df, by), [by], {"total": measure})
    totals = sums.withColumn("total", F.coalesce(stable_round(F.col("total"), scale), F.lit(0.0)))
    top = totals.orderBy(F.desc("total"), F.asc(by)).limit(k)
    # The unpartitioned window sees the k rows of the limit, nothing else.
    return top.withColumn("pct", percent(F.col("total"), F.sum("total").over(W.partitionBy()), 1))


def grouped_sums(df: DataFrame, by: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Sum of each ``{alias: column}`` per group; those of doubles are exact in any order, 0.0 for no values."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    real = {a: c for a, c in measures.items() if c in doubles}
    whole = {a: ("sum", c) for a, c in measures.items() if c not in doubles}
    if not real:
        return df.groupBy(*by).agg(*[F.sum(c).alias(a) for a, (_, c) in whole.items()])
    sums = exact_sums(df, by, real, whole)
    return sums.select(*by, *[F.coalesce(a, F.lit(0.0)).alias(a) if a in real else F.col(a) for a in measures])
