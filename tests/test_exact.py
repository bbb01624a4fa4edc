"""Exact sums against rational arithmetic."""

import random
from decimal import Decimal
from fractions import Fraction

import pytest

from estrato.operators.aggregates import grouped_sums
from estrato.operators.exact import exact_sums


def _truth(values):
    values = [v for v in values if v is not None]
    if any(v != v or abs(v) == float("inf") for v in values):
        return sum(values)
    return float(sum(Fraction(Decimal(repr(v))) for v in values)) if values else None


@pytest.fixture(scope="module")
def cases():
    draw = random.Random(1)
    groups = {
        "tiny": [1e-16] * 1000, "big": [1e23] * 2, "cancel": [1e300, 1.0, -1e300], "negative": [-0.1] * 7, "none": [None], "nan": [float("nan"), 1.0],
        "infinite": [float("inf"), 1.0], "both": [float("inf"), float("-inf")], "smallest": [5e-324] * 2, "largest": [1.7976931348623157e308, -1e292],
        "zero": [0.0, -0.0], "carry": [99999999.99999999] * 3, None: [0.1, None, 0.2],
    }
    for g in range(20):
        wide = [draw.choice([-1, 1]) * draw.random() * 10.0 ** (draw.randint(-300, 300) if g % 2 else draw.randint(-3, 9)) for _ in range(100)]
        groups[f"r{g}"] = wide + ([-v for v in wide[:80]] if g % 3 == 0 else [])
    return groups


@pytest.mark.parametrize("parts", [1, 13])
def test_any_magnitude_in_any_order(spark, cases, parts):
    table = [(k, v, -v if v is not None else None) for k, values in cases.items() for v in values]
    random.Random(parts).shuffle(table)
    df = spark.createDataFrame(table, "_x string, x double, y double").repartition(parts)
    out = exact_sums(df, ["_x"], {"s": "x", "t": "y"}, {"n": ("count", "x"), "low": ("min", "x"), "high": ("max", "y")})
    found = {r["_x"]: r for r in out.collect()}
    assert set(found) == set(cases)
    for key, values in cases.items():
        there = [v for v in values if v is not None]
        assert repr(found[key].s) == repr(_truth(values)) and found[key].n == len(there), key
        assert found[key].t is None if not there else repr(found[key].t + 0.0) == repr(_truth([-v for v in there]) + 0.0), key


def test_whole_table_and_empty_table(spark):
    df = spark.createDataFrame([(1e300,), (1.0,), (-1e300,)], "x double")
    assert exact_sums(df, [], {"s": "x"}).first().s == 1.0
    assert [tuple(r) for r in exact_sums(df.filter("false"), [], {"s": "x"}).collect()] == [(None,)]
    assert exact_sums(df.filter("false").selectExpr("x", "1 AS k"), ["k"], {"s": "x"}).count() == 0


def test_grouped_sums_mix_kinds(spark, rows):
    df = spark.createDataFrame([("a", 1e-16, 2**60), ("a", 1e-16, 2**60), ("b", None, None)], "k string, x double, n bigint")
    assert rows(grouped_sums(df, ["k"], {"n": "n", "x": "x"})) == [("a", 2**61, 2e-16), ("b", None, 0.0)]
