"""What the physical plans look like, and results for other partition counts."""

import re

import pytest
from pyspark.sql import functions as F

from estrato.operators.labels import hash_split
from estrato.plans import claims
from estrato.workload import runnable
from estrato.workload.registry import Tables

SMALL = "/root/testdata/sf0.001"
QUERIES = runnable()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


# Queries that may run Python workers.
PYTHON = {"correlation_matrix"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert any(node in text for node in ("EvalPython", "InPandas", "MapInArrow", "InArrow")) == (name in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rules_do_not_shuffle(spark):
    base = spark.read.parquet(f"{SMALL}/lineitem.parquet").select(
        *[F.lit(None).cast(t).alias(c) for c, t in {
            "incident_date": "date", "policy_start": "date", "policy_end": "date", "claim_total": "double",
            "premium": "double", "confidence_level": "string", "damage_label": "string", "incident_severity": "string",
        }.items()]
    )
    assert "Exchange" not in plan(claims.decide(base))


def test_filters_reach_the_scan(spark, capsys):
    policies = spark.read.parquet(f"{SMALL}/orders.parquet").selectExpr(
        "o_orderkey AS CUST_ID", "o_totalprice AS PREMIUM", "CAST(o_orderkey AS STRING) AS POLICY_NO",
        "CAST(o_orderdate AS DATE) AS POL_EFF_DATE", "CAST(o_orderdate AS DATE) AS POL_EXPIRY_DATE",
    )
    claims.clean_policies(policies).explain("formatted")
    pushed = re.search(r"PushedFilters: \[.*?\]", capsys.readouterr().out)[0]
    assert "GreaterThanOrEqual(o_totalprice,0.0)" in pushed and "IsNotNull(o_orderkey)" in pushed


def test_image_bytes_stay_out_of_name_queries(spark):
    images = Tables(spark, SMALL).standin("images")
    names = claims.clean_images(images, labelled=True).groupBy("label").count()
    assert "html" not in plan(names)


def test_all_panels_are_one_scan_and_equal_the_single_ones(spark):
    found = QUERIES["claim_panels"](spark, SMALL)
    text = plan(found)
    assert text.count("FileScan") == 1 and text.count("Expand") == 1 and exchanges(text) == 1
    long = {}
    for r in found.collect():
        long.setdefault(r.panel, {})[r.key, r.other] = r
    single = {n: QUERIES[n](spark, SMALL).collect() for n in ("severity_counts", "claims_by_month", "decision_share", "rule_failures", "prediction_coverage", "loss_by_type", "label_decision_crosstab")}
    assert {r.incident_severity: r.n for r in single["severity_counts"]}.items() <= {k: r.n for (k, _), r in long["severity_counts"].items()}.items()
    assert {r.month: r.n for r in single["claims_by_month"]} == {k: r.n for (k, _), r in long["claims_by_month"].items()}
    assert {r.decision_final: r.n for r in single["decision_share"]} == {k: r.n for (k, _), r in long["decision_share"].items()}
    assert {r.rule: r.n for r in single["rule_failures"]} == {k: r.n for (k, _), r in long["rule_failures"].items()}
    assert {r.category: r.n for r in single["prediction_coverage"]} == {k: r.n for (k, _), r in long["prediction_coverage"].items()}
    assert {r.incident_type: r.total for r in single["loss_by_type"]} == {k: r.total for (k, _), r in long["loss_by_type"].items()}
    crossed = {(r.damage_label, d): r[d] for r in single["label_decision_crosstab"] for d in ("LIBERADO", "REVISION_MENOR", "INVESTIGAR") if r[d]}
    assert crossed == {k: r.n for k, r in long["label_decision_crosstab"].items()}


def test_all_claims_are_cleaned(spark):
    """Nothing is dropped before the checks, which need no shuffle."""
    t = Tables(spark, SMALL)
    cleaned = QUERIES["clean_claims"](spark, SMALL)
    assert "Exchange" not in plan(cleaned) and cleaned.count() == t.lineitem.filter("l_extendedprice >= 2000 AND l_quantity > 2").count()


def test_scan_reads_only_needed_columns(spark):
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan(QUERIES["table_update"](spark, SMALL)))[1]
    assert schema == "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double"


def test_maintenance_is_aggregated_before_the_join(spark):
    text = plan(QUERIES["kpi_maintenance"](spark, SMALL))
    assert text.index("Join") < text.index("sum(costo_usd")


def test_flights_are_counted_before_the_joins(spark):
    text = plan(QUERIES["kpi_punctuality"](spark, SMALL))
    assert text.rindex("Join") < text.index("partial_sum(duracion_min")


def test_claims_are_shuffled_once_for_policy_and_customer(spark):
    """Broadcasts off, as at scale: claims, policies, customers and one result each."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        schema = {"claim_no": "string", "policy_no": "string", "claim_date": "date", "total": "double", "age": "int"}
        c = spark.createDataFrame([], ", ".join(f"{k} {v}" for k, v in schema.items()))
        t = Tables(spark, SMALL)
        joined = claims.claim_policy_customer(
            c, claims.clean_policies(t.standin("policies")), claims.clean_customers(t.standin("customers"))
        )
        text = plan(joined)
        # customers and policies by customer, policies and claims by policy number
        assert exchanges(text) == 4 and text.count("SortMergeJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


STABLE = (
    "kpi_punctuality", "kpi_maintenance", "telematics_by_vehicle", "prediction_rollup", "dedup_latest", "table_upsert",
    "table_as_of", "score_by_label", "correlation_matrix", "profile_columns", "label_index",
)


@pytest.mark.parametrize("name", STABLE)
def test_results_do_not_depend_on_partitioning(spark, rows, name):
    def result(partitions, coalesce):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        return rows(QUERIES[name](spark, SMALL))

    try:
        assert result("1", "true") == result("13", "false")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("name", ["silver_flights", "dedup_latest", "clean_metadata"])
def test_dedup_limits_groups_before_the_shuffle(spark, name):
    steps = re.findall(r"WindowGroupLimit|Exchange", plan(QUERIES[name](spark, SMALL)))
    assert steps == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_split_needs_no_shuffle(spark):
    assert "Exchange" not in plan(hash_split(Tables(spark, SMALL).documents, "doc_id"))
