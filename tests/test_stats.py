"""Profiles, quantiles, correlation and outliers against numpy and pandas."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from estrato.operators import reports, stats


@pytest.fixture(scope="module")
def skewed(spark):
    """Long tail, and one value that fills a third of the rows."""
    rng = random.Random(5)
    values = [rng.lognormvariate(0, 3) for _ in range(4000)] + [2.5] * 3000 + [-7.0] * 1000
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, i int").repartition(5)
    return np.array(values), df.unionByName(spark.createDataFrame([(None, -1), (float("nan"), -2)], "x double, i int"))


@pytest.mark.parametrize("limit", [100_000, 40, 1])
def test_exact_quantiles(skewed, limit):
    values, df = skewed
    wanted = [0.0, 0.1, 0.25, 0.5, 0.51, 0.75, 0.999, 1.0]
    out = {r.q: r.value for r in stats.exact_quantiles(df, {"x": wanted, "i": [0.5]}, limit).filter("column_name = 'x'").collect()}
    assert [out[q] for q in wanted] == pytest.approx([np.quantile(values, q) for q in wanted], rel=1e-12)


def test_quantiles_survive_bad_guesses(spark, monkeypatch):
    """With a sketch of two values almost every guess misses; counts put it right."""
    monkeypatch.setattr(stats, "SKETCH", 3)
    monkeypatch.setattr(stats, "SLACK", 0.0)
    values = [float(v * v % 101) for v in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(2)
    out = [r.value for r in stats.exact_quantiles(df, {"x": [0.07, 0.5]}, limit=4).orderBy("q").collect()]
    assert out == pytest.approx([np.quantile(values, q) for q in (0.07, 0.5)], rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert [tuple(r) for r in stats.exact_quantiles(df, {"x": [0.5]}).collect()] == [("x", 0.5, None)]


def test_profile(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), None), (None, 3.0, "c")], "i int, d double, s string")
    out = {r.column_name: r for r in stats.profile(df).collect()}
    assert (out["i"].n_values, out["i"].n_null, out["i"].n_nan, out["i"].mean) == (2, 1, 0, 1.5)
    assert (out["d"].n_values, out["d"].n_null, out["d"].n_nan, out["d"].mean, out["d"].std) == (3, 0, 1, 2.0, 1.414214)
    assert (out["s"].n_values, out["s"].n_null, out["s"].mean, out["s"].min_value) == (2, 1, None, None)
    assert (out["d"].q1, out["d"].q3) == (1.0, 3.0)


def test_correlations(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(200, 3))
    data[:, 2] = data[:, 0] * 2 + data[:, 1]
    df = spark.createDataFrame([tuple(map(float, r)) + ("t",) for r in data], "a double, b double, c double, s string")
    out = {(r.col_a, r.col_b): r.corr for r in stats.correlations(df).collect()}
    expected = np.corrcoef(data.T)
    names = ["a", "b", "c"]
    assert set(out) == {(x, y) for x in names for y in names}
    assert all(out[x, y] == pytest.approx(expected[i, j], abs=1e-6) for i, x in enumerate(names) for j, y in enumerate(names))
    # A missing value only takes its row out of its own pairs.
    hole = df.unionByName(spark.createDataFrame([(None, 9.0, 9.0, "t")], df.schema))
    assert {r.col_b: r.corr for r in stats.correlations(hole).filter("col_a = 'a'").collect()}["c"] == out["a", "c"]
    constant = df.withColumn("a", F.lit(1.0))
    assert {(r.col_a, r.col_b): r.corr for r in stats.correlations(constant, ["a", "b"]).collect()} == {
        ("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): 1.0,
    }


def test_outliers(skewed):
    values, df = skewed
    q1, q3 = np.quantile(values, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert stats.iqr_outliers(df, "x", exact=True).count() == int(((values < low) | (values > high)).sum())
    z = np.abs((values - values.mean()) / values.std(ddof=1))
    assert stats.zscore_outliers(df, "x").count() == int((z > 3).sum())


def test_sketched_quartiles_keep_their_rank_error(skewed):
    values, df = skewed
    for error in (0.05, 0.01):
        q = df.agg(F.percentile_approx(stats._real("x"), [0.25, 0.75], math.ceil(1 / error))).first()[0]
        for value, wanted in zip(q, (0.25, 0.75)):
            assert (values < value).mean() <= wanted + error and (values <= value).mean() >= wanted - error
    assert stats.iqr_outliers(df, "x").count() > 0


def test_no_spread_gives_no_score(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r.zscore_x for r in stats.zscore(df, "x").collect()] == [None, None]
    assert stats.zscore_outliers(df, "x").count() == 0


def test_correlations_of_many_columns(spark):
    """A hundred columns are one pass; values far from 0 lose nothing."""
    draw = np.random.default_rng(8)
    base = draw.normal(size=(500, 1))
    values = base * draw.normal(size=(1, 100)) + draw.normal(size=(500, 100)) + 1e6
    names = [f"c{i}" for i in range(100)]
    df = spark.createDataFrame(pd.DataFrame(values, columns=names)).repartition(5)
    found = stats.correlations(df).toPandas().pivot(index="col_a", columns="col_b", values="corr").loc[names, names]
    assert np.allclose(found.to_numpy(), np.corrcoef(values.T), atol=2e-6)


def test_histogram_leaves_infinities_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(math.inf,), (-math.inf,), (math.nan,), (None,)], "v double")
    assert [r.n for r in reports.histogram(df, "v", 3).orderBy("bin").collect()] == [3, 3, 4]


@pytest.mark.parametrize("parts", [1, 13])
def test_merged_sketches_keep_the_error_of_ranks(spark, parts):
    draw = random.Random(3)
    table = [(i % 20, draw.choice([draw.gauss(0, 1), draw.random() ** 9 * 1000, 5.0])) for i in range(60_000)]
    df = spark.createDataFrame(table, "g int, x double").repartition(parts)
    sketches = stats.sketched(df, ["g"], ["x"], error=0.02)
    assert sketches.count() == 20 and max(len(r.sketch) for r in sketches.collect()) < 20_000
    for chosen in (range(20), range(0, 20, 3), [7]):
        found = {r.q: r for r in stats.merged_quantiles(sketches.filter(F.col("g").isin(list(chosen))), error=0.02).collect()}
        values = np.sort([x for g, x in table if g in chosen])
        for q, row in found.items():
            low, high = np.searchsorted(values, row.value, "left") / len(values), np.searchsorted(values, row.value, "right") / len(values)
            assert row.n == len(values) and low - 0.05 <= q <= high + 0.05


def test_outliers_by_sketch_are_those_within_the_error(spark):
    values = [float(i) for i in range(20_000)] + [1e6, -1e6]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert sorted(r.x for r in stats.iqr_outliers(df, "x").collect()) == [-1e6, 1e6]
    assert stats.iqr_outliers(df.filter("false"), "x").count() == 0


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (1, float("nan")), (2, 3.0)], "g int, x double")
    sketches = stats.sketched(df, ["g"], ["x"])
    assert {r.g: r.n for r in sketches.collect()} == {1: 0, 2: 1}
    assert [tuple(r) for r in stats.merged_quantiles(sketches, [0.5]).collect()] == [("x", 1, 0.5, 3.0)]
    assert stats.merged_quantiles(sketches.filter("g = 1")).count() == 0
    assert stats.profile(df.filter("false")).filter("column_name = 'x'").first().median is None
