"""Report panels as Spark aggregates; only their few result rows leave Spark."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.functions.dates import day_part, month_label
from estrato.functions.numbers import percent, stable_mean, stable_round, stable_sum
from estrato.operators.aggregates import counts, n_rows
from estrato.operators.exact import exact_sums
from estrato.operators.rules import Rule
from estrato.operators.shape import require
from estrato.operators.stats import exact_quantiles
from estrato.session import cut_lineage


def domain_rows(row: DataFrame, column: str, values: Sequence[str], measures: dict[str, list[str]]) -> DataFrame:
    """One result row as a row per domain value: position, value, its measures."""
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(v).alias(column),
            *[F.col(cells[i]).alias(name) for name, cells in measures.items()],
        )
        for i, v in enumerate(values)
    ]
    return row.select(F.inline(F.array(*rows)))


def domain_counts(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows per value of a fixed domain; 0 where there are none, others left out."""
    cells = [f"n{i}" for i in range(len(values))]
    row = df.agg(*[F.count_if(F.col(column) == v).alias(c) for c, v in zip(cells, values)])
    return domain_rows(row, column, values, {"n": cells})


def panels(
    df: DataFrame, sets: dict[str, Sequence[str]], measures: dict[str, Column], required: Collection[str] = ()
) -> DataFrame:
    """Many grouped panels in one pass: (panel, key, other, measures...), a row per group of every panel.

    ``sets`` names the one or two columns that each panel groups by (none: one row for all rows).  All are grouping
    sets of one aggregate, combined before its only shuffle.  Keys are text; a panel in ``required`` leaves out groups
    without a first key.
    """
    columns = list(dict.fromkeys(c for s in sets.values() for c in s))
    # Spark numbers a grouping set by the columns that it leaves out.
    number = {n: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for n, s in sets.items()}
    if len(set(number.values())) < len(sets):
        raise ValueError("two panels group by the same columns")
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets.values()], *columns)
    found = grouped.agg(F.grouping_id().alias("_set"), *[m.alias(n) for n, m in measures.items()])

    def of_set(values: dict[str, Column]) -> Column:
        out = F
        for name, value in values.items():
            out = out.when(F.col("_set") == number[name], value)
        return out.otherwise(None) if values else F.lit(None)

    keys = [of_set({n: F.col(s[i]).cast("string") for n, s in sets.items() if len(s) > i}).cast("string") for i in range(2)]
    long = found.select(of_set({n: F.lit(n) for n in sets}).alias("panel"), keys[0].alias("key"), keys[1].alias("other"), *measures)
    return long.filter(~F.col("panel").isin(*required) | F.col("key").isNotNull()) if required else long


def sum_by(df: DataFrame, by: str, measure: str, scale: int = 2) -> DataFrame:
    """Sum per group, smallest first; a NULL group is left out, NULL values add 0."""
    sums = exact_sums(require(df, by), [by], {"total": measure})
    return sums.withColumn("total", F.coalesce(stable_round(F.col("total"), scale), F.lit(0.0))).orderBy("total", by)


def hour_counts(df: DataFrame, hour: str) -> DataFrame:
    """Rows per hour with the part of the day."""
    found = counts(require(df, hour).select(F.col(hour).cast("int").alias("hour")), "hour")
    return found.withColumn("day_part", day_part(F.col("hour"))).orderBy("hour")


def month_counts(df: DataFrame, day: str, null_label: str | None = "NaT") -> DataFrame:
    return counts(df.select(month_label(F.col(day), null_label).alias("month")), "month").orderBy("month")


def label_counts(df: DataFrame, column: str, null_label: str) -> DataFrame:
    labelled = df.select(F.coalesce(F.col(column), F.lit(null_label)).alias(column))
    return counts(labelled, column).orderBy(F.desc("n"), column)


def histogram(df: DataFrame, column: str, bins: int = 20, cut: bool = False) -> DataFrame:
    """Equal bins over [min, max], the last one closed; empty bins are kept.

    A constant column gets a range of width 1 around its value.  NULL, NaN and
    infinities are left out.  The bounds are a scalar subquery, so the values are read
    twice; ``cut`` writes them first if they are dear to compute.
    """
    values = df.select(F.col(column).cast("double").alias("x")).filter(~F.isnan("x") & (F.abs("x") < float("inf")))
    if cut:
        values = cut_lineage(values)
    lo, hi = F.min("x"), F.max("x")
    half = F.when(lo == hi, 0.5).otherwise(0.0)
    bounds = values.agg(F.struct((lo - half).alias("lo"), (hi + half).alias("hi")).alias("b")).scalar()
    width = (bounds["hi"] - bounds["lo"]) / bins
    position = F.least(F.floor((F.col("x") - bounds["lo"]) / width), F.lit(bins - 1)).cast("int")
    found = counts(values.select(position.alias("bin")), "bin")
    edges = df.sparkSession.range(0, bins, 1, 1).select(F.col("id").cast("int").alias("bin"))
    return edges.join(found, "bin", "left").select(
        "bin",
        stable_round(bounds["lo"] + width * F.col("bin"), 4).alias("from_value"),
        stable_round(bounds["lo"] + width * (F.col("bin") + 1), 4).alias("to_value"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def center(df: DataFrame, column: str, cut: bool = False) -> DataFrame:
    """Mean and exact median of the values that are there; one row."""
    values = df.select(column)
    if cut:
        values = cut_lineage(values)
    median = exact_quantiles(values, {column: [0.5]})
    return values.agg(
        stable_mean(F.col(column), 4).alias("mean"),
        stable_round(median.select("value").scalar(), 4).alias("median"),
    )


def measure_spread(df: DataFrame, by: str, measure: str, scale: int = 6) -> DataFrame:
    """Mean and sample deviation per group, the deviation of a single row being 0."""
    spread = F.coalesce(F.stddev_samp(measure), F.lit(0.0))
    return (
        require(df, by)
        .groupBy(by)
        .agg(stable_mean(F.col(measure), scale).alias("mean"), stable_round(spread, scale).alias("std"))
        .orderBy("mean", by)
    )


def complete_points(df: DataFrame, *columns: str) -> DataFrame:
    """The columns of the rows in which none of them is missing."""
    return df.select(*columns).na.drop("any", subset=list(columns))


def unpivoted(row: DataFrame, name: str, value: str, columns: Sequence[str]) -> DataFrame:
    """One result row as rows of (name, value)."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns]
    return row.select(F.inline(F.array(*pairs)))


def coverage(df: DataFrame, label: str, level: str, reliable: Sequence[str]) -> DataFrame:
    """Rows with and without a label, reliable and not, with percentages of all rows."""
    is_reliable = F.coalesce(F.col(level).isin(*reliable), F.lit(False))
    parts = {
        "with_prediction": F.col(label).isNotNull(),
        "without_prediction": F.col(label).isNull(),
        "reliable": is_reliable,
        "not_reliable": ~is_reliable,
    }
    row = df.agg(n_rows().alias("_all"), *[F.count_if(c).alias(n) for n, c in parts.items()])
    pairs = [F.struct(F.lit(n).alias("category"), F.col(n).alias("n"), F.col("_all")) for n in parts]
    return row.select(F.inline(F.array(*pairs))).select(
        "category", "n", percent(F.col("n"), F.col("_all")).alias("pct")
    )


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``rows`` by fixed ``columns`` values; a NULL row label is left out."""
    cells = [F.count_if(F.col(columns) == v).alias(v) for v in values]
    return require(df, rows).groupBy(rows).agg(*cells).orderBy(rows)


def rule_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Records failing each rule, most frequent first; one pass for all rules."""
    row = df.agg(*[F.count_if(r.failed()).alias(r.name) for r in rules])
    return unpivoted(row, "rule", "n", [r.name for r in rules]).orderBy(F.desc("n"), "rule")


def measure_by_domain(df: DataFrame, by: str, measure: str, values: Sequence[str], scale: int = 2) -> DataFrame:
    """Mean and sum per value of a fixed domain; an absent value has neither."""
    means, totals = ([f"{m}{i}" for i in range(len(values))] for m in ("mean", "total"))
    out = []
    for mean, total, v in zip(means, totals, values):
        hit = F.when(F.col(by) == v, F.col(measure))
        some = F.count_if(F.col(by) == v) > 0
        out.append(stable_mean(hit, scale).alias(mean))
        out.append(F.when(some, stable_sum(hit, scale)).alias(total))
    return domain_rows(df.agg(*out), by, values, {"mean": means, "total": totals})


def mean_by(df: DataFrame, by: str, measure: str, scale: int = 4) -> DataFrame:
    return (
        require(df, by)
        .groupBy(by)
        .agg(stable_mean(F.col(measure), scale).alias("mean"))
        .orderBy("mean", by)
    )


def executive_kpis(
    df: DataFrame, decision: str, decisions: Sequence[str], label: str, score: str, amount: str
) -> DataFrame:
    """The KPI row: totals per decision, predictions, amount, amount at risk (last decision)."""
    row = df.agg(
        n_rows().alias("total"),
        *[F.count_if(F.col(decision) == d).alias(d.lower()) for d in decisions],
        F.count_if(F.col(label).isNotNull()).alias("with_prediction"),
        stable_mean(F.col(score), 4).alias("mean_score"),
        stable_sum(F.col(amount), 2).alias("total_amount"),
        stable_sum(F.when(F.col(decision) == decisions[-1], F.col(amount)), 2).alias("amount_at_risk"),
    )
    parts = {f"{c}_pct": percent(F.col(c), F.col("total"), 1) for c in [*[d.lower() for d in decisions], "with_prediction"]}
    return row.withColumns(parts)
