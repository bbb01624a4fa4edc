"""Report panels over the decision table."""

from __future__ import annotations

from estrato.fixed import (
    COHERENT,
    DECISIONS,
    INCOHERENT,
    NO_DECISION,
    NO_LEVEL,
    NO_PREDICTION,
    RELIABLE_LEVELS,
    SEVERITIES,
)
from estrato.operators import reports as panel
from estrato.operators.aggregates import share, top_share
from estrato.plans import claims as plan
from estrato.plans.claims import CLAIM_RULES
from estrato.session import cut_lineage
from estrato.workload.claims import DECIDED, decided
from estrato.workload.registry import Tables, mean, pct, query, rounded, summed

W = f"WITH {DECIDED}"


def _domain(values) -> str:
    return ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))


# --- business view: these panels read claims and policies only ------------------


@query(
    "severity_counts",
    f"{W} SELECT CAST(position AS INTEGER) AS position, v AS incident_severity, "
    "(SELECT count(*) FROM decided d WHERE d.incident_severity = v) AS n "
    f"FROM (VALUES {_domain(SEVERITIES)}) x(position, v)",
)
def severity_counts(t: Tables):
    return panel.domain_counts(decided(t, predictions=False), "incident_severity", SEVERITIES)


@query(
    "loss_by_type",
    f"{W} SELECT incident_type, {summed('claim_total')} AS total FROM decided "
    "WHERE incident_type IS NOT NULL GROUP BY incident_type",
)
def loss_by_type(t: Tables):
    return panel.sum_by(decided(t, predictions=False), "incident_type", "claim_total")


@query(
    "claims_by_hour",
    f"{W} SELECT CAST(incident_hour AS INTEGER) AS hour, count(*) AS n, CASE WHEN incident_hour < 6 THEN 'night' "
    "WHEN incident_hour < 12 THEN 'morning' WHEN incident_hour < 18 THEN 'afternoon' ELSE 'evening' END AS day_part "
    "FROM decided WHERE incident_hour IS NOT NULL GROUP BY incident_hour",
)
def claims_by_hour(t: Tables):
    return panel.hour_counts(decided(t, predictions=False), "incident_hour")


@query(
    "top_makes_loss",
    f"{W}, sums AS (SELECT auto_make, {summed('claim_total')} AS total FROM decided "
    "WHERE auto_make IS NOT NULL GROUP BY auto_make ORDER BY total DESC, auto_make LIMIT 5) "
    f"SELECT auto_make, total, {pct('total', '(SELECT sum(total) FROM sums)', 1)} AS pct FROM sums",
)
def top_makes_loss(t: Tables):
    return top_share(decided(t, predictions=False), "auto_make", "claim_total", 5)


_EDGE = "lo + (hi - lo) / 20 * "


@query(
    "amount_histogram",
    f"{W}, b AS (SELECT min(claim_total) AS lo, max(claim_total) AS hi FROM decided), "
    "placed AS (SELECT least(floor((claim_total - lo) / ((hi - lo) / 20)), 19) AS bin FROM decided, b "
    "WHERE claim_total IS NOT NULL) "
    f"SELECT CAST(i AS INTEGER) AS bin, {rounded(_EDGE + 'i', 4)} AS from_value, "
    f"{rounded(_EDGE + '(i + 1)', 4)} AS to_value, (SELECT count(*) FROM placed WHERE placed.bin = i) AS n "
    "FROM range(20) r(i), b",
)
def amount_histogram(t: Tables):
    return panel.histogram(decided(t, predictions=False), "claim_total", 20, cut=True)


@query(
    "amount_center",
    f"{W} SELECT {mean('claim_total', 4)} AS mean, {rounded('median(claim_total)', 4)} AS median FROM decided",
)
def amount_center(t: Tables):
    return panel.center(decided(t, predictions=False), "claim_total", cut=True)


@query(
    "claims_by_month",
    f"{W} SELECT coalesce(strftime(claim_date, '%Y-%m'), 'NaT') AS month, count(*) AS n FROM decided GROUP BY 1",
)
def claims_by_month(t: Tables):
    return panel.month_counts(decided(t, predictions=False), "claim_date")


# --- prediction view --------------------------------------------------------------


@query(
    "prediction_counts",
    f"{W} SELECT coalesce(damage_label, '{NO_PREDICTION}') AS damage_label, count(*) AS n FROM decided GROUP BY 1",
)
def prediction_counts(t: Tables):
    return panel.label_counts(decided(t), "damage_label", NO_PREDICTION)


def _share_sql(expression: str, name: str) -> str:
    return (
        f"{W}, c AS (SELECT {expression} AS {name}, count(*) AS n FROM decided GROUP BY 1) "
        f"SELECT {name}, n, {pct('n', '(SELECT sum(n) FROM c)')} AS pct FROM c"
    )


@query("confidence_share", _share_sql(f"coalesce(confidence_level, '{NO_LEVEL}')", "confidence_level"))
def confidence_share(t: Tables):
    return share(decided(t), "confidence_level", NO_LEVEL, cut=True)


@query(
    "coherence_share",
    _share_sql(f"CASE WHEN r5_coherencia_severidad THEN '{COHERENT}' ELSE '{INCOHERENT}' END", "coherente"),
)
def coherence_share(t: Tables):
    named = decided(t).selectExpr(
        f"CASE WHEN coalesce(r5_coherencia_severidad, true) THEN '{COHERENT}' ELSE '{INCOHERENT}' END AS coherente"
    )
    return share(named, "coherente", cut=True)


@query(
    "score_by_label",
    f"{W} SELECT damage_label, {mean('damage_score', 6)} AS mean, "
    f"{rounded('coalesce(stddev_samp(damage_score), 0)', 6)} AS std FROM decided "
    "WHERE damage_label IS NOT NULL GROUP BY damage_label",
)
def score_by_label(t: Tables):
    return panel.measure_spread(decided(t), "damage_label", "damage_score")


@query(
    "score_vs_amount",
    f"{W} SELECT damage_label, damage_score, claim_total FROM decided WHERE damage_label IS NOT NULL "
    "AND damage_score IS NOT NULL AND claim_total IS NOT NULL",
)
def score_vs_amount(t: Tables):
    return panel.complete_points(decided(t), "damage_label", "damage_score", "claim_total")


@query(
    "prediction_coverage",
    f"""{W}, parts AS (
    SELECT 'with_prediction' AS category, count(damage_label) AS n FROM decided
    UNION ALL SELECT 'without_prediction', count(*) - count(damage_label) FROM decided
    UNION ALL SELECT 'reliable', count(*) FILTER (confidence_level IN ('alta', 'media')) FROM decided
    UNION ALL SELECT 'not_reliable', count(*) - count(*) FILTER (confidence_level IN ('alta', 'media')) FROM decided)
    SELECT category, n, {pct('n', '(SELECT count(*) FROM decided)')} AS pct FROM parts""",
)
def prediction_coverage(t: Tables):
    return panel.coverage(decided(t), "damage_label", "confidence_level", RELIABLE_LEVELS)


# --- decision view ------------------------------------------------------------------


@query("decision_share", _share_sql(f"coalesce(decision_final, '{NO_DECISION}')", "decision_final"))
def decision_share(t: Tables):
    return share(decided(t), "decision_final", NO_DECISION, cut=True)


@query(
    "label_decision_crosstab",
    f"{W} SELECT damage_label, "
    + ", ".join(f"count(*) FILTER (decision_final = '{d}') AS {d}" for d in DECISIONS)
    + " FROM decided WHERE damage_label IS NOT NULL GROUP BY damage_label",
)
def label_decision_crosstab(t: Tables):
    return panel.crosstab(decided(t), "damage_label", "decision_final", DECISIONS)


@query(
    "rule_failures",
    f"{W} "
    + " UNION ALL ".join(f"SELECT '{r.name}' AS rule, count(*) FILTER (NOT {r.name}) AS n FROM decided" for r in CLAIM_RULES),
)
def rule_failures(t: Tables):
    return panel.rule_failures(decided(t), CLAIM_RULES)


@query(
    "amount_by_decision",
    f"{W} SELECT CAST(position AS INTEGER) AS position, v AS decision_final, "
    f"{mean('claim_total', 2)} AS mean, {summed('claim_total')} AS total "
    f"FROM (VALUES {_domain(DECISIONS)}) x(position, v) LEFT JOIN decided ON decision_final = v GROUP BY position, v",
)
def amount_by_decision(t: Tables):
    return panel.measure_by_domain(decided(t), "decision_final", "claim_total", DECISIONS)


@query(
    "failures_by_severity",
    f"{W} SELECT incident_severity, {mean('reglas_fallidas', 4)} AS mean FROM decided "
    "WHERE incident_severity IS NOT NULL GROUP BY incident_severity",
)
def failures_by_severity(t: Tables):
    return panel.mean_by(decided(t), "incident_severity", "reglas_fallidas")


_N = {d: f"count(*) FILTER (decision_final = '{d}')" for d in DECISIONS}


@query(
    "executive_kpis",
    f"{W} SELECT count(*) AS total, "
    + ", ".join(f"{n} AS {d.lower()}, {pct(n, 'count(*)', 1)} AS {d.lower()}_pct" for d, n in _N.items())
    + f", count(damage_label) AS with_prediction, {pct('count(damage_label)', 'count(*)', 1)} AS with_prediction_pct, {mean('damage_score', 4)} AS mean_score, "
    f"{summed('claim_total')} AS total_amount, "
    + summed("claim_total", 2, "decision_final = 'INVESTIGAR'")
    + " AS amount_at_risk FROM decided",
)
def executive_kpis(t: Tables):
    return panel.executive_kpis(
        decided(t), "decision_final", DECISIONS, "damage_label", "damage_score", "claim_total"
    )


# --- all panels at once -----------------------------------------------------------------


def _panel(name: str, key: str, other: str = "NULL", condition: str = "TRUE") -> str:
    return (
        f"SELECT '{name}' AS panel, CAST({key} AS VARCHAR) AS key, CAST({other} AS VARCHAR) AS other, count(*) AS n, "
        f"CAST(coalesce({summed('claim_total')}, 0) AS DOUBLE) AS total, CAST(coalesce(sum(reglas_fallidas), 0) AS BIGINT) AS failed "
        f"FROM decided WHERE {condition} GROUP BY 1, 2, 3"
    )


def _count(name: str, key: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS panel, '{key}' AS key, CAST(NULL AS VARCHAR) AS other, count(*) FILTER ({condition}) AS n, "
        "CAST(NULL AS DOUBLE) AS total, CAST(NULL AS BIGINT) AS failed FROM decided"
    )


_ALL_PANELS = " UNION ALL ".join(
    [
        *[_panel(n, c, condition=f"{c} IS NOT NULL") for n, c in (("severity_counts", "incident_severity"), ("loss_by_type", "incident_type"), ("claims_by_hour", "incident_hour"), ("loss_by_make", "auto_make"))],
        _panel("claims_by_month", "coalesce(strftime(claim_date, '%Y-%m'), 'NaT')"),
        _panel("prediction_counts", f"coalesce(damage_label, '{NO_PREDICTION}')"),
        _panel("confidence_share", f"coalesce(confidence_level, '{NO_LEVEL}')"),
        _panel("coherence_share", f"CASE WHEN r5_coherencia_severidad THEN '{COHERENT}' ELSE '{INCOHERENT}' END"),
        _panel("decision_share", f"coalesce(decision_final, '{NO_DECISION}')"),
        _panel("label_decision_crosstab", "damage_label", "decision_final", "damage_label IS NOT NULL"),
        _panel("all_claims", "NULL"),
        *[_count("rule_failures", r.name, f"NOT {r.name}") for r in CLAIM_RULES],
        _count("prediction_coverage", "with_prediction", "damage_label IS NOT NULL"),
        _count("prediction_coverage", "without_prediction", "damage_label IS NULL"),
        _count("prediction_coverage", "reliable", "confidence_level IN ('alta', 'media')"),
        _count("prediction_coverage", "not_reliable", "confidence_level IS NULL OR confidence_level NOT IN ('alta', 'media')"),
    ]
)


@query("claim_panels", f"{W} {_ALL_PANELS}")
def claim_panels(t: Tables):
    """Every panel that counts or adds, from one scan of the written decision table."""
    return plan.claim_panels(cut_lineage(decided(t)))
