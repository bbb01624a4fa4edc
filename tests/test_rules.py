"""Decisions, prediction roll-up, gold joins and panels on edge rows."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from estrato.fixed import DECISIONS, SEVERITIES
from estrato.operators import reports
from estrato.operators.aggregates import imbalance, share, top_share
from estrato.operators.rules import Rule, apply_rules
from estrato.plans import claims
from estrato.workload import oracles, runnable

BASE = (
    "claim_no string, incident_date date, policy_start date, policy_end date, claim_total double, premium double, "
    "confidence_level string, damage_label string, incident_severity string"
)
D = dt.date
START, END = D(2024, 1, 1), D(2024, 12, 31)


@pytest.fixture(scope="module")
def decided(spark):
    return claims.decide(
        spark.createDataFrame(
            [
                ("start", START, START, END, 30.0, 10.0, "alta", "scratch", "Minor Damage"),
                ("end", END, START, END, 30.0, 10.0, "media", "glass", "Total Loss"),
                ("early", D(2023, 12, 31), START, END, 30.0, 10.0, None, None, None),
                ("dear", START, START, END, 30.01, 10.0, None, None, "Total Loss"),
                ("blank", None, None, None, None, None, None, None, None),
                ("two", D(2025, 1, 1), START, END, 1.0, 10.0, "baja", "glass", None),
                ("all", D(2025, 1, 1), START, END, 99.0, 10.0, "baja", "dent", "Major Damage"),
            ],
            BASE,
        )
    )


def test_decisions(decided, rows):
    found = {r[0]: r[1:] for r in rows(decided, "claim_no", "reglas_fallidas", "decision_final", "motivos_revision")}
    assert found == {
        "start": (0, "LIBERADO", ""),
        "end": (0, "LIBERADO", ""),
        "early": (1, "REVISION_MENOR", "Póliza no vigente"),
        "dear": (1, "REVISION_MENOR", "Monto excesivo"),
        "blank": (0, "LIBERADO", ""),
        "two": (2, "INVESTIGAR", "Póliza no vigente | Predicción no confiable"),
        "all": (
            4,
            "INVESTIGAR",
            "Póliza no vigente | Monto excesivo | Predicción no confiable | Severidad incoherente",
        ),
    }


def test_number_of_reasons_is_number_of_failures(decided):
    reasons = F.when(F.col("motivos_revision") == "", 0).otherwise(F.size(F.split("motivos_revision", r" \| ")))
    assert decided.filter(reasons != F.col("reglas_fallidas")).count() == 0


def test_rules_are_data(spark, rows):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    out = apply_rules(df, [Rule("small", "too big", ("x",), "x < 3"), Rule("always", "never")], ("ok", "check"))
    assert rows(out, "x", "small", "always", "decision_final", "motivos_revision") == [
        (None, True, True, "ok", ""),
        (1, True, True, "ok", ""),
        (5, False, True, "check", "too big"),
    ]


def test_rollup_takes_all_values_from_the_best_image(spark, rows):
    predictions = spark.createDataFrame(
        [
            ("a.jpg", "scratch", 0.9, "alta", True),
            ("b.jpg", "dent", 0.95, "alta", True),
            ("c.jpg", "glass", 0.95, "media", False),
            ("d.jpg", "dent", 0.2, "baja", None),
            ("lost.jpg", "dent", 1.0, "alta", True),
            ("free.jpg", "dent", 1.0, "alta", True),
        ],
        "image_name string, damage_label string, damage_score double, confidence_level string, is_reliable boolean",
    )
    metadata = spark.createDataFrame(
        [("a.jpg", "C1", "V1"), ("b.jpg", "C1", "V1"), ("c.jpg", "C1", "V2"), ("d.jpg", "C2", "V3"), ("free.jpg", None, "V4")],
        "image_name string, claim_no string, chassis_no string",
    )
    assert rows(claims.prediction_rollup(predictions, metadata)) == [
        ("C1", "V2", "glass", 0.95, "media", 2, 3),
        ("C2", "V3", "dent", 0.2, "baja", 0, 1),
    ]


def _sources(spark):
    c = spark.createDataFrame(
        [("C1", "P1"), ("C2", "P2"), ("C3", "P9"), ("C4", "PX")], "claim_no string, policy_no string"
    ).select(
        "*",
        *[F.lit(None).cast(t).alias(n) for n, t in {"claim_date": "date", "severity": "string", "hour": "int", "type": "string", "collision_type": "string", "number_of_vehicles_involved": "int", "injury": "string", "number_of_witnesses": "int"}.items()],
        F.lit(1.0).alias("total"),
        F.lit(30).alias("age"),
    )
    p = spark.createDataFrame([("P1", 1, "V1"), ("P2", 9, "V2"), ("PX", 1, "V1"), ("PX", 1, "V3")], "POLICY_NO string, CUST_ID bigint, CHASSIS_NO string").select(
        "*",
        F.lit(1.0).alias("PREMIUM"),
        *[F.lit(START).alias(n) for n in ("POL_EFF_DATE", "POL_EXPIRY_DATE")],
        *[F.lit("m").alias(n) for n in ("MAKE", "MODEL")],
        F.lit(2020).alias("MODEL_YEAR"),
    )
    u = spark.createDataFrame([(1, "Ana", "Perez", START, "x")], "customer_id bigint, first_name string, last_name string, date_of_birth date, address string")
    return c, p, u


def test_gold_join_is_inner_and_decision_base_is_left(spark, rows):
    c, p, u = _sources(spark)
    gold = claims.claim_policy_customer(c, p, u)
    assert rows(gold, "claim_no", "first_name", "chassis_no") == [
        ("C1", "Ana", "V1"), ("C2", None, "V2"), ("C4", "Ana", "V1"), ("C4", "Ana", "V3"),
    ]
    base = claims.decision_base(c, p, u)
    assert rows(base, "claim_no", "premium") == [("C1", 1.0), ("C2", 1.0), ("C3", None), ("C4", 1.0), ("C4", 1.0)]
    assert "address" not in base.columns
    # Sources that are left out change no other column.
    short = claims.decision_base(c, p)
    assert short.dtypes == base.dtypes
    assert rows(short.drop("first_name", "last_name", "date_of_birth")) == rows(base.drop("first_name", "last_name", "date_of_birth"))


def test_predictions_meet_claims_before_policies(spark, rows):
    """Broadcasts off, as at scale: the wider policies come last, and no column moves twice."""
    c, p, u = _sources(spark)
    best = spark.createDataFrame([("C1", "dent", 0.5, "media", 1, 2), ("C4", "glass", 0.9, "alta", 1, 1), ("C9", "dent", 0.1, "baja", 0, 1)], "claim_no string, damage_label string, damage_score double, confidence_level string, imagenes_confiables bigint, total_imagenes bigint")
    c = c.unionByName(c.filter("claim_no = 'C1'")).repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        base = claims.decision_base(c, p, u, best)
        text = base._jdf.queryExecution().optimizedPlan().toString()
        last, *before = [line for line in text.splitlines() if "Join LeftOuter" in line]
        assert "_policy" in last and any("claim_no" in line for line in before)
        assert not any("AS incident_date" in line for line in text.splitlines()[text.splitlines().index(last) :])
        dealt = claims.insured_claims(c, claims.insured(p, u), best, dealt=True)
        assert dealt.dtypes == base.dtypes and rows(dealt) == rows(base)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(base, "claim_no", "damage_label", "chassis_no") == [
        ("C1", "dent", "V1"), ("C1", "dent", "V1"), ("C2", None, "V2"), ("C3", None, None), ("C4", "glass", "V1"), ("C4", "glass", "V3"),
    ]


def test_rollup_is_the_same_without_vehicles(spark, rows):
    predictions = spark.createDataFrame(
        [("a.jpg", "dent", 0.5, "media", True), ("a.jpg", "dent", 0.5, "media", True), ("b.jpg", "glass", 0.5, "media", None)],
        "image_name string, damage_label string, damage_score double, confidence_level string, is_reliable boolean",
    )
    images = [("a.jpg", "1", "C1", "V1"), ("a.jpg", "1", "C1", "V2"), ("a.jpg", "0", "C2", "V9"), ("b.jpg", None, "C1", None), ("b.jpg", None, "C1", "V3")]
    metadata = spark.createDataFrame(images, "image_name string, image_id string, claim_no string, chassis_no string")
    whole, short = (claims.prediction_rollup(predictions, claims.clean_metadata(metadata, vehicles)) for vehicles in (True, False))
    assert "chassis_no" not in short.columns and rows(whole.drop("chassis_no")) == rows(short)
    assert rows(short) == [("C1", "glass", 0.5, "media", 2, 3)]


def test_telematics_summary(spark, rows):
    events = spark.createDataFrame(
        [("V", dt.datetime(2024, 1, 2), 1.0, 2.0, 1.005), ("V", None, 2.0, 3.0, 2.0), ("V", dt.datetime(2024, 1, 1), 3.0, 4.0, None)],
        "chassis_no string, event_timestamp timestamp, latitude double, longitude double, speed double",
    )
    assert rows(claims.telematics_by_vehicle(events)) == [
        ("V", 1.5, 2.0, 1.01, 2.0, 3.0, 3, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    ]


# --- panels ------------------------------------------------------------------------


def test_domain_panels(spark, rows):
    df = spark.createDataFrame([("Total Loss", 1.0), ("Total Loss", 2.0), ("Odd", 5.0), (None, 1.0)], "s string, v double")
    assert [tuple(r) for r in reports.domain_counts(df, "s", SEVERITIES).orderBy("position").collect()] == [
        (0, "Minor Damage", 0), (1, "Major Damage", 0), (2, "Total Loss", 2), (3, "Trivial Damage", 0),
    ]
    assert rows(reports.measure_by_domain(df, "s", "v", ("Total Loss", "Gone"))) == [
        (0, "Total Loss", 1.5, 3.0), (1, "Gone", None, None),
    ]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,), (float("nan"),)], "v double")
    out = [tuple(r) for r in reports.histogram(df, "v", 5).orderBy("bin").collect()]
    assert [r[3] for r in out] == [2, 2, 2, 2, 3]
    assert out[0][1:3] == (0.0, 2.0) and out[4][1:3] == (8.0, 10.0)
    constant = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    out = [tuple(r) for r in reports.histogram(constant, "v", 4).orderBy("bin").collect()]
    assert (out[0][1], out[-1][2], sum(r[3] for r in out)) == (2.5, 3.5, 2)
    empty = reports.histogram(constant.filter("v < 0"), "v", 4)
    assert [r.n for r in empty.collect()] == [0] * 4


def test_center(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "v double")
    for cut in (False, True):
        assert tuple(reports.center(df, "v", cut=cut).first()) == (4.25, 3.0)
    assert tuple(reports.center(df.filter("v < 0"), "v").first()) == (None, None)


def test_shares(spark, rows):
    df = spark.createDataFrame([("a",)] * 2 + [(None,)], "g string")
    for cut in (False, True):
        assert rows(share(df, "g", "none", cut=cut)) == [("a", 2, 66.67), ("none", 1, 33.33)]
    assert rows(share(df, "g")) == [(None, 1, 33.33), ("a", 2, 66.67)]
    assert rows(imbalance(df, "g")) == [(33.33, False)]
    rare = spark.createDataFrame([("a",)] * 30 + [("b",)], "g string")
    assert rows(imbalance(rare, "g")) == [(3.23, True)]
    assert rows(imbalance(rare.filter("false"), "g")) == [(None, False)]


def test_top_share_is_within_the_top(spark):
    df = spark.createDataFrame([("a", 6.0), ("b", 3.0), ("c", 1.0), (None, 99.0), ("d", None)], "g string, v double")
    assert [tuple(r) for r in top_share(df, "g", "v", 2).collect()] == [("a", 6.0, 66.7), ("b", 3.0, 33.3)]


def test_spread_of_one_row_is_zero(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0), (None, 1.0)], "g string, v double")
    assert rows(reports.measure_spread(df, "g", "v")) == [("a", 1.0, 0.0), ("b", 2.0, 1.414214)]


def test_small_panels(spark, decided, rows):
    df = spark.createDataFrame([("a", D(2024, 5, 1), 3), (None, None, None), ("a", D(2024, 5, 2), 20)], "l string, d date, h int")
    assert rows(reports.month_counts(df, "d")) == [("2024-05", 2), ("NaT", 1)]
    assert rows(reports.label_counts(df, "l", "none")) == [("a", 2), ("none", 1)]
    assert rows(reports.hour_counts(df, "h")) == [(20, 1, "evening"), (3, 1, "night")]
    assert rows(reports.crosstab(decided, "damage_label", "decision_final", DECISIONS)) == [
        ("dent", 0, 0, 1), ("glass", 1, 0, 1), ("scratch", 1, 0, 0),
    ]
    assert [r.n for r in reports.rule_failures(decided, claims.CLAIM_RULES).collect()] == [3, 2, 2, 1, 0, 0]
    coverage = reports.coverage(decided, "damage_label", "confidence_level", ("alta", "media"))
    assert rows(coverage, "category", "n") == [
        ("not_reliable", 5), ("reliable", 2), ("with_prediction", 4), ("without_prediction", 3),
    ]


def test_panels_count_claims_once_for_each_policy_and_customer(spark, tmp_path):
    """A repeated claim number, policy or customer loses no row of the decision table, in the panels neither."""
    day = dt.datetime(2000, 5, 1)
    tables = {
        "customer": (
            [(1, "Ana", 5, 10.0, "FURNITURE"), (1, "Eva", 5, 20.0, "HOUSEHOLD"), (2, "Leo", 5, 10.0, "BUILDING"), (4, "Sol", 5, -1.0, "MACHINERY")],
            "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        ),
        "orders": (
            [(10, 1, "O", 90000.0, day, "1-URGENT"), (20, 2, "O", 90000.0, day, "1-URGENT"), (20, 2, "F", 20000.0, day, "5-LOW"), (30, 3, "O", 90000.0, day, "5-LOW")],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "lineitem": (
            [
                (10, 1, 1, 1, 9.0, 9000.0, 0.06, 0.01, "A", "F", day), (10, 2, 1, 1, 9.0, 40000.0, 0.09, 0.01, "N", "F", day),
                (20, 3, 1, 4, 9.0, 9000.0, 0.01, 0.0, "A", "F", day), (30, 4, 1, 1, 9.0, 9000.0, 0.06, 0.01, "R", "O", day), (40, 5, 1, 2, 9.0, 9000.0, 0.1, 0.01, "R", "O", day),
            ],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (lines, kinds) in tables.items():
        pq.write_table(spark.createDataFrame(lines, kinds).toArrow(), tmp_path / f"{name}.parquet")
    names = "decision_counts", "severity_counts", "amount_center", "executive_kpis", "claim_panels"
    found = {n: runnable()[n](spark, str(tmp_path)).toArrow() for n in names}
    # Two claims with two customers, one with two policies, one without a customer and one without a policy.
    assert sum(found["decision_counts"]["n"].to_pylist()) == 2 * 2 + 2 + 1 + 1
    duck = connect(str(tmp_path))
    assert {n: differences(t, duck.sql(oracles()[n]).to_arrow_table()) for n, t in found.items()} == dict.fromkeys(names, [])


def test_kpis_of_nothing(spark, decided):
    scored = decided.withColumn("damage_score", F.lit(0.5))
    kpis = reports.executive_kpis(scored, "decision_final", DECISIONS, "damage_label", "damage_score", "claim_total")
    assert kpis.first().asDict()["investigar"] == 2
    none = reports.executive_kpis(
        scored.filter("false"), "decision_final", DECISIONS, "damage_label", "damage_score", "claim_total"
    ).first()
    assert (none["total"], none["liberado_pct"], none["total_amount"]) == (0, None, 0.0)
