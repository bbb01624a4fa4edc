"""Profiling, correlation, quantiles and outliers."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.functions.numbers import stable_mean, stable_round
from estrato.schemas import literal_rows

# Accuracy of the sketches that narrow the search of exact_quantiles, and the
# share of ranks by which their guesses are widened.
SKETCH = 10_000
SLACK = 2 / SKETCH


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _real(column: str):
    """Value as double, with NaN taken as missing."""
    x = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(x), x)


def profile(df: DataFrame, columns: Sequence[str] | None = None, error: float = 0.001) -> DataFrame:
    """One row per column: values, NULLs, NaNs; mean, deviation, extremes and quartiles of numbers; extremes of text.

    All columns share one aggregate.  The quartiles come from sketches of bounded size, with the given error of ranks.
    """
    numeric = set(numeric_columns(df))
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    columns = list(columns or df.columns)
    names = ["n_values", "n_null", "n_nan", "mean", "std", "min_value", "max_value", "min_text", "max_text", "n", "sketch"]
    measures = []
    for i, c in enumerate(columns):
        col, x = F.col(f"`{c}`"), _real(c) if c in numeric else F.lit(None).cast("double")
        text = col if c in texts else F.lit(None).cast("string")
        found = [
            F.count(col),
            F.count_if(col.isNull()),
            F.count_if(F.isnan(col)) if c in floats else F.lit(0).cast("bigint"),
            stable_mean(x, 6),
            stable_round(F.stddev_samp(x), 6),
            F.min(x),
            F.max(x),
            F.min(text),
            F.max(text),
            F.count(x),
            quantile_sketch(x, error) if c in numeric else F.lit(None).cast("binary"),
        ]
        measures.append(F.struct(F.lit(c).alias("column_name"), *[m.alias(n) for m, n in zip(found, names)]).alias(f"p{i}"))
    rows = df.agg(*measures).select(F.inline(F.array(*[F.col(f"p{i}") for i in range(len(columns))])))
    quartiles = [_of_sketch("sketch", q, F.col("n")).alias(n) for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
    return rows.select("column_name", *names[:-2], *quartiles)


def quantile_sketch(x: Column, error: float = 0.01) -> Column:
    """Aggregate: a mergeable sketch of numbers of bounded size; NULL and NaN are left out.

    Ranks of its quantiles are off by about ``error``; up to ``sketch_size`` values they are exact.
    """
    return F.kll_sketch_agg_double(x, F.lit(sketch_size(error)))


def sketch_size(error: float) -> int:
    return max(8, min(65_535, math.ceil(4 / error)))


def _of_sketch(sketch: str, q: float, n: Column) -> Column:
    """The smallest value that a share ``q`` of the values does not exceed; NULL of none."""
    return F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(q)))


def sketched(df: DataFrame, by: Sequence[str], columns: Sequence[str], error: float = 0.01) -> DataFrame:
    """(by..., column_name, n, sketch): one sketch per group and column, to be stored and merged later."""
    found = [F.struct(F.lit(c).alias("column_name"), F.count(_real(c)).alias("n"), quantile_sketch(_real(c), error).alias("sketch")).alias(f"s{i}") for i, c in enumerate(columns)]
    wide = df.groupBy(*by).agg(*found)
    return wide.select(*by, F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))


def merged_quantiles(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), error: float = 0.01) -> DataFrame:
    """(column_name, n, q, value) over all groups of a table of ``sketched`` that a filter has left: no row is read again."""
    some = sketches.filter("n > 0").groupBy("column_name")
    merged = some.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(sketch_size(error))).alias("sketch"))
    each = [F.struct(F.lit(float(q)).alias("q"), _of_sketch("sketch", q, F.col("n")).alias("value")) for q in quantiles]
    return merged.select("column_name", "n", F.inline(F.array(*each)))


def correlations(df: DataFrame, columns: Sequence[str] | None = None, scale: int = 6) -> DataFrame:
    """Pearson correlation of each pair of numeric columns as (col_a, col_b, corr).

    A row counts for a pair if both values are there.  Tasks multiply blocks of rows with themselves, after a
    shift by the means, and report one row of sums per pair and task; so a hundred columns are no dearer than
    their products.  A column without spread, or with an infinity, has no correlation: NULL.
    """
    columns = list(columns or numeric_columns(df))
    size = len(columns)
    reals = df.select(*[_real(c).alias(f"x{i}") for i, c in enumerate(columns)])
    shift = reals.agg(*[F.avg(f"x{i}") for i in range(size)]).first()
    shift = np.array([0.0 if v is None or not math.isfinite(v) else v for v in shift])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, size, size))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns], axis=1)
            there = (~np.isnan(x)).astype(np.float64)
            x = np.where(there > 0, x - shift, 0.0)
            with np.errstate(invalid="ignore"):
                sums += np.stack([there.T @ there, x.T @ there, there.T @ x, (x * x).T @ there, there.T @ (x * x), x.T @ x])
        a, b = np.divmod(np.arange(size * size), size)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (a, b, *sums.reshape(6, -1))], ["a", "b", "n", "sa", "sb", "qa", "qb", "p"])

    found = reals.mapInArrow(work, "a long, b long, n double, sa double, sb double, qa double, qb double, p double")
    total = found.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "qa", "qb", "p")])
    n = F.when(F.col("n") > 0, F.col("n"))
    spread = [F.col(q) - F.col(s) * F.col(s) / n for s, q in (("sa", "qa"), ("sb", "qb"))]
    # What rounding leaves of a constant column is no spread.
    real = [F.when(v > 1e-12 * F.col(q), v) for v, q in zip(spread, ("qa", "qb"))]
    corr = F.try_divide(F.col("p") - F.col("sa") * F.col("sb") / n, F.sqrt(real[0]) * F.sqrt(real[1]))
    names = F.array(*[F.lit(c) for c in columns])
    corr = F.when(corr > 1, 1.0).when(corr < -1, -1.0).when(~F.isnan(corr), corr)
    return total.select(F.get(names, F.col("a").cast("int")).alias("col_a"), F.get(names, F.col("b").cast("int")).alias("col_b"), stable_round(corr, scale).alias("corr"))


class _Bracket:
    """Open ranks of one column, known to lie strictly between two values.

    ``start`` values lie at or below ``lo`` and ``size`` between ``lo`` and
    ``hi``; None stands for an open end.
    """

    def __init__(self, column: str, ranks: set[int], lo: float | None, hi: float | None, start: int, size: int):
        self.column, self.ranks, self.lo, self.hi, self.start, self.size = column, ranks, lo, hi, start, size
        self.guess: tuple[float, float] = (math.nan, math.nan)

    @property
    def x(self) -> Column:
        return F.col(f"`{self.column}`")

    def sketch(self) -> Column:
        """Values a little outside the open ranks."""
        inside = F.lit(True)
        if self.lo is not None:
            inside &= self.x > self.lo
        if self.hi is not None:
            inside &= self.x < self.hi
        at = [(rank - self.start) / max(self.size - 1, 1) for rank in self.ranks]
        return _sketch(F.when(inside, self.x), [(min(at), max(at))])

    def few(self, limit: int) -> bool:
        """Whether few enough values can lie strictly inside the guess.

        A guess spans 2 SLACK of the ranks (and two neighbouring ones), and the
        sketch may be off by 1 / SKETCH on either side.
        """
        return self.size * 2 * (SLACK + 1 / SKETCH) <= limit

    def probes(self, limit: int) -> list[Column]:
        """Counts around the guess and, if few values can be inside it, those at the open ranks."""
        a, b = self.guess
        out = [F.count_if(c) for c in (self.x < a, self.x <= a, self.x < b, self.x <= b)]
        if self.few(limit):
            inside = F.sort_array(F.collect_list(F.when((self.x > a) & (self.x < b), self.x)))
            out += [F.get(inside, (F.lit(rank) - F.count_if(self.x <= a)).try_cast("int")) for rank in sorted(self.ranks)]
        return out

    def resolve(self, probed: list, found: dict) -> list[_Bracket]:
        """Note the values that are settled; return brackets for the other ranks."""
        a, b = self.guess
        below, upto_a, below_b, upto_b = probed[:4]
        inside = dict(zip(sorted(self.ranks), probed[4:]))
        left, middle, right = set(), set(), set()
        for rank in self.ranks:
            if rank < below:
                left.add(rank)
            elif rank < upto_a:
                found[self.column, rank] = a
            elif rank < below_b:
                if rank in inside:
                    found[self.column, rank] = inside[rank]
                else:
                    middle.add(rank)
            elif rank < upto_b:
                found[self.column, rank] = b
            else:
                right.add(rank)
        parts = (
            (left, self.lo, a, self.start, below - self.start),
            (middle, a, b, upto_a, below_b - upto_a),
            (right, b, self.hi, upto_b, self.start + self.size - upto_b),
        )
        return [_Bracket(self.column, *part) for part in parts if part[0]]


def exact_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]], limit: int = 100_000) -> DataFrame:
    """Exact interpolated quantiles as rows of (column_name, q, value).

    Spark's exact percentile gathers all distinct values in one task.  Here a
    sketch of bounded size first guesses a narrow bracket around each wanted
    rank; then one aggregate for all columns counts what lies below, on and
    between the edges.  A value that fills many rows ends up on an edge, where
    it is only counted.  The values inside are sorted in one task if no more than
    ``limit`` can be there, which holds at once up to some 100 million rows;
    beyond, the bracket is sketched again.  Counts decide, so a bad guess costs a
    round, not the result.  The driver sees a few numbers per round.  NULL and
    NaN are left out.
    """
    columns = list(wanted)
    data = df.select(*[_real(c).alias(c) for c in columns])
    first = data.agg(
        *[
            F.struct(
                F.count(F.col(f"`{c}`")).alias("n"),
                _sketch(F.col(f"`{c}`"), [(q, q) for q in wanted[c]]).alias("guesses"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    ).first()

    found: dict[tuple[str, int], float] = {}
    open_: list[_Bracket] = []
    for i, c in enumerate(columns):
        n = first[f"c{i}"]["n"]
        for j, q in enumerate(wanted[c] if n else ()):
            at = q * (n - 1)
            open_.append(_Bracket(c, {math.floor(at), math.ceil(at)}, None, None, 0, n))
            open_[-1].guess = tuple(first[f"c{i}"]["guesses"][2 * j : 2 * j + 2])
    while open_:
        row = data.agg(*[_named(b.probes(limit)).alias(f"b{i}") for i, b in enumerate(open_)]).first()
        open_ = [part for i, b in enumerate(open_) for part in b.resolve(list(row[f"b{i}"]), found)]
        if open_:
            row = data.agg(*[b.sketch().alias(f"b{i}") for i, b in enumerate(open_)]).first()
            for i, b in enumerate(open_):
                b.guess = tuple(row[f"b{i}"])

    rows = []
    for i, c in enumerate(columns):
        n = first[f"c{i}"]["n"]
        for q in wanted[c]:
            value = None
            if n:
                at = q * (n - 1)
                low, high = found[c, math.floor(at)], found[c, math.ceil(at)]
                value = low + (high - low) * (at - math.floor(at))
            rows.append((c, float(q), value))
    return literal_rows(df.sparkSession, {"column_name": "string", "q": "double", "value": "double"}, rows)


def _sketch(x: Column, spans: Sequence[tuple[float, float]]) -> Column:
    """Two values per span of rank fractions, a little outside it; one sketch for all."""
    at = [f for low, high in spans for f in (max(low - SLACK, 0.0), min(high + SLACK, 1.0))]
    return F.percentile_approx(x, at, SKETCH)


def _named(columns: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"p{i}") for i, c in enumerate(columns)])


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5, error: float = 0.05, exact: bool = False) -> DataFrame:
    """Rows strictly outside Q1 - k IQR and Q3 + k IQR.

    The quartiles come from a sketch with the given rank error, as a scalar
    subquery; ``exact`` takes exact interpolated quartiles.
    """
    x = _real(column)
    if exact:
        q = exact_quantiles(df, {column: [0.25, 0.75]})
        q1, q3 = [F.lit(r["value"]) for r in q.orderBy("q").collect()]
    else:
        row = df.agg(F.count(x).alias("n"), quantile_sketch(x, error).alias("s"))
        q = row.select(F.array(*[_of_sketch("s", p, F.col("n")) for p in (0.25, 0.75)]).alias("q")).scalar()
        q1, q3 = q[0], q[1]
    margin = (q3 - q1) * k
    return df.filter((x < q1 - margin) | (x > q3 + margin))


def zscore(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Add the distance from the mean in sample deviations; NULL if there is no spread."""
    x = _real(column)
    stats = df.agg(F.struct(F.avg(x).alias("mean"), F.stddev_samp(x).alias("std")).alias("s")).scalar()
    return df.withColumn(alias or f"zscore_{column}", F.try_divide(x - stats["mean"], stats["std"]))


def zscore_outliers(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """Rows more than ``limit`` deviations from the mean, with their z-score."""
    return zscore(df, column, f"zscore_{column}").filter(F.abs(F.col(f"zscore_{column}")) > limit)
