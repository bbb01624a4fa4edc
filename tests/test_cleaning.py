"""Edge rows of cleaning and checks."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from estrato.fixed import CONFIDENCE_LEVELS
from estrato.functions.dates import day_part, month_label, parse_date
from estrato.functions.numbers import banded, percent, stable_round, stable_sum
from estrato.functions.text import file_extension, file_label, file_name, has_text, join_text, split_name
from estrato.operators.dedup import dedup_by, unique_on
from estrato.operators.shape import Check, conform, in_range, keep_valid, require, require_text, role, tag_rejects
from estrato.plans import claims
from estrato.workload import runnable


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_parse_date_takes_first_fitting_format(spark):
    texts = ["03/04/1990", "31/12/1990", "1990-04-03", "31-12-1990", "1990/04/03", "3/4/1990", "text", "", None]
    day = dt.date
    assert column(spark, texts, "string", parse_date) == [
        day(1990, 3, 4), day(1990, 12, 31), day(1990, 4, 3), day(1990, 12, 31), day(1990, 4, 3), None, None, None, None,
    ]
    assert column(spark, ["29/02/2023", "02/30/2024", "2024-02-29"], "string", parse_date) == [None, None, day(2024, 2, 29)]
    assert column(spark, ["03/04/1990"], "string", lambda c: parse_date(c, ["dd/MM/yyyy"])) == [day(1990, 4, 3)]


def test_split_name(spark):
    names = [" Perez, Ana ", "Madonna", ", ", "  ", "A, B, C", None]
    got = column(spark, names, "string", lambda c: F.struct(*split_name(c)))
    assert [tuple(r) for r in got] == [
        ("Perez", "Ana"), ("Madonna", None), (",", None), ("", None), ("A", "B"), (None, None),
    ]


def test_join_text_keeps_places_of_missing_parts(spark):
    df = spark.createDataFrame([("X", None, None), (None, None, 10001)], "a string, b string, zip int")
    assert [r[0] for r in df.select(join_text(F.col("a"), F.col("b"), F.col("zip"))).collect()] == ["X, , ", ", , 10001"]


def test_file_parts(spark):
    paths = ["dbfs:/x/y/scratch_01.JPG", "nounderscore.png", "a/b/noext", "a/b/", None]
    assert column(spark, paths, "string", file_name) == ["scratch_01.JPG", "nounderscore.png", "noext", "", None]
    assert column(spark, paths, "string", lambda c: file_label(file_name(c))) == [
        "scratch", "nounderscore.png", "noext", "", None,
    ]
    assert column(spark, paths, "string", lambda c: file_extension(file_name(c))) == ["jpg", "png", "", "", None]


def test_has_text(spark):
    assert column(spark, ["a", " ", "", None], "string", has_text) == [True, False, False, False]


def test_stable_round(spark):
    values = [1.005, 0.285, 2.675, -1.005, 1e300, float("inf"), None]
    assert column(spark, values, "double", lambda c: stable_round(c, 2)) == [1.01, 0.29, 2.68, -1.01, 1e300, math.inf, None]
    assert math.isnan(column(spark, [float("nan")], "double", lambda c: stable_round(c, 2))[0])
    # Rounded once: what is below a tie stays below.
    assert column(spark, [0.30499999999999994, 0.00499999999], "double", lambda c: stable_round(c, 2)) == [0.3, 0.0]


def test_stable_sum_is_exact_in_any_order(spark):
    def total(values, scale=2):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        return df.agg(stable_sum(F.col("v"), scale)).first()[0]

    assert total([0.1] * 10, 6) == 1.0
    assert total([1e12 + 0.25, 0.01, -1e12, -0.26]) == 0.0
    assert total([-1.5, 0.25, None]) == -1.25
    assert total([None]) == 0.0
    assert total([1e15, 0.01, -1e15]) == 0.01 and total([1e-7] * 100_000, 6) == 0.01
    assert total([float("inf"), 1.0]) == math.inf and math.isnan(total([float("nan"), 1.0]))
    # Beyond exact range the query fails.
    with pytest.raises(Exception, match="can't be summed exactly"):
        total([1e300, 1.0])
    assert total([9e14] * 20_000) == 1.8e19


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (1, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [33.33, None, None]


def test_bands(spark):
    scores = [0.8, 0.79, 0.5, 0.1, None]
    assert column(spark, scores, "double", lambda c: banded(c, CONFIDENCE_LEVELS)) == ["alta", "media", "media", "baja", None]


def test_day_part_conventions(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 19, 20, 23, None]
    assert column(spark, hours, "int", day_part)[:10] == (
        ["night"] * 2 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 4
    )
    late = column(spark, hours, "int", lambda c: day_part(c, night_from=20))
    assert late[6:] == ["evening", "evening", "night", "night", None]


def test_month_label(spark):
    days = [dt.date(2024, 5, 31), None]
    assert column(spark, days, "date", month_label) == ["2024-05", "NaT"]
    assert column(spark, days, "date", lambda c: month_label(c, None)) == ["2024-05", None]


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", "2024-02-30", "k"), ("7.0", "2.5", "2024-02-29", "k")], "A string, b string, d string, rest string")
    out = conform(df, {"a": "int", "b": "double", "d": "date", "gone": "string"}, optional=["gone"])
    assert out.dtypes == [("a", "int"), ("b", "double"), ("d", "date"), ("gone", "string"), ("rest", "string")]
    assert [tuple(r) for r in out.collect()] == [
        (1, None, None, None, "k"),
        (None, 2.5, dt.date(2024, 2, 29), None, "k"),
    ]
    assert conform(df, {"a": "int"}, keep_rest=False).columns == ["a"]
    with pytest.raises(ValueError, match="absent: key"):
        conform(df, {"a": "int", "KEY": "string"})


def test_requirements(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, " "), (4, None)], "k int, s string")
    assert rows(require(df, "k"), "k") == [(1,), (3,), (4,)]
    assert rows(require_text(df, "s"), "s") == [("a",), ("b",)]
    assert role(df, {"x": "s"}).columns == ["x"]


def test_range_edges(spark):
    values = [-90.0, 90.0, 90.1, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.v for r in df.filter(in_range("v", -90, 90)).collect()] == [-90.0, 90.0]


def test_valid_and_rejected_rows_make_up_the_input(spark, rows):
    checks = (Check("positive", "v >= 0"), Check("keyed", "k IS NOT NULL"))
    df = spark.createDataFrame([(1, 0.0), (None, -1.0), (2, None), (3, float("nan"))], "k int, v double")
    tagged = tag_rejects(df, checks)
    assert rows(tagged, "k", "rejected_by") == [(None, "positive,keyed"), (1, ""), (2, "positive"), (3, "")]
    assert rows(tagged.filter("rejected_by = ''"), "k") == rows(keep_valid(df, checks), "k")


def test_policies(spark, rows):
    raw = spark.createDataFrame(
        [
            ("P1", 1, "10.5", "2024-01-01", "2024-01-01"),
            ("P2", 1, "bad", "2024-01-01", "2024-12-31"),
            ("P3", 1, "-1", "2024-01-01", "2024-12-31"),
            ("P4", None, "1", "2024-01-01", "2024-12-31"),
            ("P5", 1, "1", "2024-12-31", "2024-01-01"),
            ("P6", 1, "1", "31/12/2024", "2024-01-01"),
            (None, 1, "1", "2024-01-01", "2024-12-31"),
            ("P7", 1, "0", "2024-01-01", "2024-12-31"),
        ],
        "POLICY_NO string, CUST_ID int, PREMIUM string, POL_EFF_DATE string, POL_EXPIRY_DATE string",
    )
    assert rows(claims.clean_policies(raw), "POLICY_NO") == [("P1",), ("P7",)]


def test_claims_drop_superseded_columns(spark, rows):
    raw = spark.createDataFrame(
        [("C1", "P", "2024-01-01", 0.0, 1, "x"), ("C2", "P", "bad", 5.0, 20, "x"), ("C3", "P", None, -1.0, 20, "x"), ("C4", "P", None, None, 20, "x"), ("C5", "P", None, 1.0, 0, "x")],
        "claim_no string, policy_no string, claim_date string, total double, age int, date_1 string",
    )
    out = claims.clean_claims(raw)
    assert "date_1" not in out.columns
    assert rows(out, "claim_no", "claim_date") == [("C1", dt.date(2024, 1, 1)), ("C2", None)]


def test_telematics_keep_missing_time(spark, rows):
    raw = spark.createDataFrame(
        [("V", None, 1.0, 1.0, 0.0), ("V", "2024-01-01 00:00:00", 91.0, 1.0, 0.0), ("V", "2024-01-01 00:00:00", 1.0, None, 0.0), ("V", "x", 1.0, 1.0, -0.1), (None, "x", 1.0, 1.0, 1.0)],
        "chassis_no string, event_timestamp string, latitude double, longitude double, speed double",
    )
    assert rows(claims.clean_telematics(raw), "chassis_no", "event_timestamp") == [("V", None)]


def test_customers(spark, rows):
    raw = spark.createDataFrame(
        [(1, "03/04/1990", " Perez, Ana ", "B", None, None), (2, "x", "A, B", "B", "N", 1), (3, "1990-01-01", "Madonna", "B", "N", 1), (4, "1990-01-01", ", ", "B", "N", 1), (5, "1990-01-01", None, "B", "N", 1)],
        "customer_id int, date_of_birth string, name string, borough string, neighborhood string, zip_code int",
    )
    out = claims.clean_customers(raw)
    assert rows(out, "customer_id", "first_name", "last_name", "address") == [(1, "Ana", "Perez", "B, , ")]


def test_images(spark, rows):
    raw = spark.createDataFrame([("a/dent_1.jpg",), ("a/b/",), ("x.png",), ("a/_y.jpg",), (None,)], "path string")
    assert rows(claims.clean_images(raw), "image_name") == [("_y.jpg",), ("dent_1.jpg",), ("x.png",)]
    assert rows(claims.clean_images(raw, labelled=True), "label") == [("dent",), ("x.png",)]


def test_dedup_is_the_same_for_any_partitioning(spark, rows):
    data = [(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (None, 1, "n"), (None, 2, "m"), (2, None, "q"), (2, None, "r")]
    df = spark.createDataFrame(data, "k int, o int, v string")
    expected = [(None, 2, "m"), (1, 5, "b"), (2, None, "r")]
    for n in (1, 3, 7):
        assert rows(dedup_by(df.repartition(n), ["k"], ["o"])) == expected
    assert rows(dedup_by(df, ["k"], ["o"], keep="first")) == [(None, 1, "n"), (1, 4, "z"), (2, None, "q")]


def test_unique_on(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(unique_on(df, ["k"])) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="repeats 2 times"):
        unique_on(df.unionByName(df.filter("k = 1")), ["k"]).collect()
    # The check survives column pruning.
    with pytest.raises(Exception, match="repeats 2 times"):
        unique_on(df.unionByName(df.filter("k = 1")), ["k"]).select("k").collect()


def test_null_audit_counts_addresses_with_a_missing_part(spark, tmp_path):
    customers = [
        (1, "Customer#1", 5, 10.0, "BUILDING"),
        (2, "Customer#2", 1, 10.0, "BUILDING"),  # no neighborhood
        (3, "Customer#3", 5, -1.0, "BUILDING"),  # no zip code
        (4, "Customer#4", None, None, None),  # no part at all
    ]
    kinds = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(customers, kinds).write.parquet(str(tmp_path / "customer.parquet"))
    found = dict(runnable()["null_audit"](spark, str(tmp_path)).collect())
    assert found["nulos_address"] == 3 and len(found) == 5
