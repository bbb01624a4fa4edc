"""Joins with hot keys, orphans, join audits, quality checks."""

import pytest
from pyspark.sql import functions as F

from estrato.operators import quality
from estrato.operators.joins import enrich, hot_keys, join_audit, orphans, split_join
from estrato.operators.shape import Check
from estrato.plans import training


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has key 7, some have none, some have no partner."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).cast("int").alias("k")
    )


@pytest.fixture(scope="module")
def dimension(spark):
    """Key 7 and key 3 occur twice, the keys from 35 on not at all."""
    return spark.createDataFrame([(k, f"v{k}") for k in range(35)] + [(7, "again"), (3, "again"), (None, "nobody")], "k int, v string")


def test_hot_keys(facts):
    assert hot_keys(facts, "k", 0.2) == [7]
    assert hot_keys(facts.filter("false"), "k") == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_join(facts, dimension, rows, how):
    plain = facts.join(dimension, "k", how)
    assert rows(split_join(facts, dimension, "k", how, salts=5)) == rows(plain, "k", "id", "v")
    assert rows(split_join(facts, dimension, "k", how, hot=[])) == rows(plain, "k", "id", "v")
    assert rows(split_join(facts, dimension, "k", how, hot=[3, 999])) == rows(plain, "k", "id", "v")


def test_split_join_spreads_the_hot_key(spark, facts, dimension):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = split_join(facts, dimension, "k").filter("k = 7").select(F.spark_partition_id().alias("p"))
        assert out.distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_split_join_rejects_other_joins(facts, dimension):
    with pytest.raises(ValueError):
        split_join(facts, dimension, "k", "full")


def test_enrich_guard(facts, dimension):
    assert enrich(facts, dimension.dropDuplicates(["k"]), ["k"], guard=True).count() == 3000
    with pytest.raises(Exception, match="repeats 2 times"):
        enrich(facts, dimension, ["k"], guard=True).collect()
    with pytest.raises(Exception, match="repeats 2 times"):
        enrich(facts, dimension, ["k"], guard=True).count()


def test_orphans(facts, dimension, rows):
    expected = rows(
        facts.filter("k IS NOT NULL").join(dimension, "k", "left_anti").groupBy("k").agg(F.count("*").alias("n"))
    )
    assert expected and rows(orphans(facts, "k", dimension, "k")) == expected


def test_join_audit_counts_without_joining(facts, dimension):
    audit = join_audit(facts, F.col("k"), dimension, F.col("k")).first().asDict()
    assert audit == {
        "left_rows": 3000,
        "right_rows": 38,
        "joined_rows": facts.join(dimension, "k").count(),
        "left_unmatched": facts.join(dimension, "k", "left_anti").count(),
        "right_unmatched": dimension.join(facts, "k", "left_anti").count(),
        "fanout_keys": 2,
    }
    empty = join_audit(facts.filter("false"), F.col("k"), dimension.filter("false"), F.col("k")).first()
    assert list(empty) == [0] * 6


def test_audits(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (None, -1.0), (1, None)], "k int, v double")
    assert rows(quality.audit_long(df, {"no_key": "k IS NULL", "negative": "v < 0"})) == [("negative", 1), ("no_key", 1)]
    checks = (Check("key", "k IS NOT NULL"), Check("value", "v >= 0"))
    assert dict(rows(quality.reject_counts(df, checks))) == {"key": 1, "value": 2, "any_check": 2, "all_rows": 3}
    assert rows(quality.duplicate_keys(df, "k")) == [(1, 2)]
    assert rows(quality.value_ranges(df, "k", "v")) == [("k", 1.0, 1.0), ("v", -1.0, 5.0)]
    assert rows(quality.table_counts({"a": df, "b": df.filter("k = 1")})) == [("a", 3), ("b", 2)]


def test_types_and_gate(spark):
    df = spark.createDataFrame([(1, 5.0)], "k int, v double")
    quality.expect_types(df, {"K": "int", "v": "double"})
    with pytest.raises(TypeError, match="v: double, not date; w: absent, not int"):
        quality.expect_types(df, {"v": "date", "w": "int"})
    row = quality.audit(df, {"bad": "k = 1"})
    assert quality.gate(row, at_most={"bad": 1}) == {"bad": 1}
    with pytest.raises(ValueError, match="bad = 1 > 0"):
        quality.gate(row, at_most={"bad": 0})


def test_readiness(spark):
    images = spark.createDataFrame([("p", "a_1.png", "a", b"x"), ("q", "b_1.png", "b", None)], "path string, image_name string, label string, content binary")
    assert training.require_ready(images) == {
        "total": 2, "blank_label": 0, "blank_path": 0, "blank_image_name": 0, "null_content": 1, "ready": True,
    }
    assert training.missing_columns(images.drop("content")) == ["content"]
    with pytest.raises(ValueError, match="total = 0 < 1"):
        training.require_ready(images.filter("false"))
    with pytest.raises(ValueError, match="blank_label = 2 > 0"):
        training.require_ready(images.withColumn("label", F.lit("")))
    assert [tuple(r) for r in training.extension_counts(images).collect()] == [("png", 2)]
