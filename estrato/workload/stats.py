"""Profiles, correlation, quantiles and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato.functions.numbers import stable_round
from estrato.operators import stats
from estrato.session import cut_lineage
from estrato.workload.registry import Tables, mean, query, rounded

_LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Customers with missing, undefined and blank values.
_CUSTOMERS = (
    "SELECT c_custkey, CASE WHEN c_nationkey = 2 THEN NULL WHEN c_nationkey = 3 THEN '' ELSE c_name END AS c_name, "
    "CASE WHEN c_nationkey = 4 THEN NULL ELSE c_nationkey END AS c_nationkey, "
    "CASE WHEN c_nationkey = 5 THEN NULL WHEN c_nationkey = 6 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS c_acctbal, "
    "CASE WHEN c_nationkey < 9 THEN NULL ELSE c_mktsegment END AS c_mktsegment, CAST(NULL AS DOUBLE) AS nothing FROM customer"
)
_PROFILED = {"c_custkey": True, "c_name": False, "c_nationkey": True, "c_acctbal": True, "c_mktsegment": False, "nothing": True}


def _quantile(values: str, q: float) -> str:
    """The smallest value that a share ``q`` of the rows of ``values`` (x) does not exceed, by counting."""
    ranked = f"SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM ({values})"
    return f"(SELECT min(x) FROM ({ranked}) WHERE i >= {q} * n)"


def _profile(column: str, numeric: bool) -> str:
    values = f"SELECT CAST({column} AS DOUBLE) AS x FROM c WHERE {column} IS NOT NULL AND NOT isnan(CAST({column} AS DOUBLE))"
    figures = {"n_values": f"(SELECT count(*) FROM c WHERE {column} IS NOT NULL)", "n_null": f"(SELECT count(*) FROM c WHERE {column} IS NULL)"}
    figures["n_nan"] = f"(SELECT count(*) FROM c WHERE isnan(CAST({column} AS DOUBLE)))" if numeric else "CAST(0 AS BIGINT)"
    numbers = {"mean": mean("x", 6), "std": rounded("stddev_samp(x)", 6), "min_value": "min(x)", "max_value": "max(x)"}
    figures |= {n: f"(SELECT CAST({e} AS DOUBLE) FROM ({values}))" if numeric else "CAST(NULL AS DOUBLE)" for n, e in numbers.items()}
    figures |= {f"{m}_text": "CAST(NULL AS VARCHAR)" if numeric else f"(SELECT {m}({column}) FROM c)" for m in ("min", "max")}
    figures |= {n: _quantile(values, q) if numeric else "CAST(NULL AS DOUBLE)" for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    return f"SELECT '{column}' AS column_name, " + ", ".join(f"{e} AS {n}" for n, e in figures.items())


@query("profile_columns", f"WITH c AS ({_CUSTOMERS}) " + " UNION ALL ".join(_profile(c, n) for c, n in _PROFILED.items()))
def profile_columns(t: Tables):
    """Sketches of up to 65,535 values are exact, so their quartiles are those of the rows here."""
    t.customer.createOrReplaceTempView("customer")
    return stats.profile(t.spark.sql(_CUSTOMERS), error=1e-9)


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rounded(f'corr({a}, {b})', 6)} AS corr FROM lineitem"
        for a in _LINE_MEASURES
        for b in _LINE_MEASURES
    ),
)
def correlation_matrix(t: Tables):
    return stats.correlations(t.lineitem, _LINE_MEASURES)


@query(
    "exact_quartiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({q} AS DOUBLE) AS q, {rounded(f'quantile_cont({c}, {q})', 6)} AS value "
        "FROM lineitem"
        for c in ("l_extendedprice", "l_quantity")
        for q in (0.25, 0.5, 0.75)
    ),
)
def exact_quartiles(t: Tables):
    out = stats.exact_quantiles(t.lineitem, {c: [0.25, 0.5, 0.75] for c in ("l_extendedprice", "l_quantity")})
    return out.withColumn("value", stable_round(F.col("value"), 6))


@query(
    "iqr_outliers",
    "WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) "
    "SELECT event_id, user_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)",
)
def iqr_outliers(t: Tables):
    return stats.iqr_outliers(t.events, "value", exact=True).select("event_id", "user_id", "value")


_VALUES = "SELECT value AS x FROM events"


@query(
    "iqr_outliers_approx",
    f"WITH q AS (SELECT {_quantile(_VALUES, 0.25)} AS q1, {_quantile(_VALUES, 0.75)} AS q3) "
    "SELECT event_id, user_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)",
)
def iqr_outliers_approx(t: Tables):
    """Outlier rows by sketched quartiles."""
    return stats.iqr_outliers(t.events, "value", error=1e-9).select("event_id", "user_id", "value")


_CHOSEN = "event_type IN ('click', 'view', 'error')"


@query(
    "sketched_quartiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (SELECT count({c}) FROM events WHERE {_CHOSEN}) AS n, CAST({q} AS DOUBLE) AS q, "
        f"{_quantile(f'SELECT CAST({c} AS DOUBLE) AS x FROM events WHERE {_CHOSEN}', q)} AS value"
        for c in ("value", "user_id")
        for q in (0.25, 0.5, 0.75)
    ),
)
def sketched_quartiles(t: Tables):
    """Quartiles of a selection of event types, from stored sketches of all of them."""
    sketches = cut_lineage(stats.sketched(t.events, ["event_type"], ["value", "user_id"], error=1e-9))
    return stats.merged_quantiles(sketches.filter(_CHOSEN), error=1e-9)


@query(
    "zscore_outliers",
    "WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events) "
    f"SELECT event_id, value, {rounded('(value - m) / d', 6)} AS zscore_value FROM events, s "
    "WHERE abs((value - m) / d) > 3",
)
def zscore_outliers(t: Tables):
    out = stats.zscore_outliers(t.events, "value")
    return out.select("event_id", "value", stable_round(F.col("zscore_value"), 6).alias("zscore_value"))
