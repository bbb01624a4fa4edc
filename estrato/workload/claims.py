"""Joined claim tables, prediction roll-up, decisions."""

from __future__ import annotations

import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F

from estrato import schemas
from estrato.fixed import SEVERITIES
from estrato.operators.joins import join_audit, unpartitioned
from estrato.operators.quality import reject_figures
from estrato.operators.shape import keep_valid
from estrato.plans import claims as plan
from estrato.plans.audits import FIGURES
from estrato.session import new_shared_folder
from estrato.sources.layers import Layer
from estrato.workload import cleaning
from estrato.workload.registry import Tables, mean, query, raw, rounded

INSURED = f"""{cleaning.POLICIES}, {cleaning.CUSTOMERS}, insured AS (
    SELECT p.*, first_name, last_name, date_of_birth, address
    FROM policies_clean p LEFT JOIN customers_clean u ON p.CUST_ID = u.customer_id)"""
VEHICLES = f"""{cleaning.TELEMATICS}, vehicles AS (
    SELECT chassis_no, {mean('speed', 2)} AS avg_speed, {rounded('max(speed)', 2)} AS max_speed,
           {rounded('min(speed)', 2)} AS min_speed, {mean('latitude', 6)} AS avg_latitude,
           {mean('longitude', 6)} AS avg_longitude, count(*) AS total_events,
           min(event_timestamp) AS first_event, max(event_timestamp) AS last_event
    FROM telematics_clean GROUP BY chassis_no)"""
JOINED = f"""{cleaning.CLAIMS}, {INSURED}, joined AS (
    SELECT claim_no, claims_clean.policy_no, claim_date, total AS claim_total, age, CHASSIS_NO AS chassis_no, PREMIUM AS premium,
           POL_EFF_DATE AS policy_start_date, POL_EXPIRY_DATE AS policy_end_date, CUST_ID AS cust_id,
           first_name, last_name, date_of_birth, address
    FROM claims_clean JOIN insured ON claims_clean.policy_no = insured.POLICY_NO)"""
# Window form of the roll-up: number the images of a claim, best first.
ROLLUP = f"""{raw('predictions')}, {cleaning.METADATA}, located AS (
    SELECT p.*, claim_no, chassis_no,
           row_number() OVER (PARTITION BY claim_no ORDER BY damage_score DESC, p.image_name DESC, damage_label DESC) AS rn
    FROM predictions p JOIN metadata_clean m ON p.image_name = m.image_name),
    rollup_ AS (
    SELECT claim_no, max(CASE WHEN rn = 1 THEN chassis_no END) AS chassis_no,
           max(CASE WHEN rn = 1 THEN damage_label END) AS damage_label,
           {rounded('max(damage_score)', 4)} AS damage_score,
           max(CASE WHEN rn = 1 THEN confidence_level END) AS confidence_level,
           count(*) FILTER (is_reliable) AS imagenes_confiables, count(*) AS total_imagenes
    FROM located GROUP BY claim_no)"""
BASE = f"""{cleaning.CLAIMS}, {INSURED}, {ROLLUP}, base AS (
    SELECT c.claim_no, c.policy_no, claim_date, claim_date AS incident_date, total AS claim_total,
           type AS incident_type, collision_type, severity AS incident_severity, hour AS incident_hour,
           number_of_vehicles_involved, injury AS bodily_injuries, number_of_witnesses AS witnesses,
           CAST(NULL AS VARCHAR) AS authorities_contacted, CAST(NULL AS VARCHAR) AS police_report_available,
           damage_label, damage_score, confidence_level, imagenes_confiables, total_imagenes,
           i.CHASSIS_NO AS chassis_no, PREMIUM AS premium, POL_EFF_DATE AS policy_start,
           POL_EXPIRY_DATE AS policy_end, MAKE AS auto_make, MODEL AS auto_model, MODEL_YEAR AS auto_year,
           first_name, last_name, date_of_birth
    FROM claims_clean c LEFT JOIN insured i ON c.policy_no = i.POLICY_NO
                        LEFT JOIN rollup_ r ON c.claim_no = r.claim_no)"""
DECIDED = f"""{BASE}, judged AS (
    SELECT *, coalesce(incident_date >= policy_start AND incident_date <= policy_end, TRUE) AS r1_poliza_vigente,
           coalesce(claim_total <= premium * 3, TRUE) AS r2_monto_razonable, TRUE AS r3_reporte_policial,
           coalesce(confidence_level <> 'baja', TRUE) AS r4_prediccion_confiable,
           coalesce(NOT (damage_label IN ('scratch', 'dent') AND incident_severity IN ('Major Damage', 'Total Loss')),
                    TRUE) AS r5_coherencia_severidad,
           TRUE AS r6_tiempo_razonable
    FROM base), counted AS (
    SELECT *, CAST(NOT r1_poliza_vigente AS INTEGER) + CAST(NOT r2_monto_razonable AS INTEGER)
              + CAST(NOT r4_prediccion_confiable AS INTEGER) + CAST(NOT r5_coherencia_severidad AS INTEGER)
              AS reglas_fallidas
    FROM judged), decided AS (
    SELECT *, CASE reglas_fallidas WHEN 0 THEN 'LIBERADO' WHEN 1 THEN 'REVISION_MENOR' ELSE 'INVESTIGAR' END
              AS decision_final,
           concat_ws(' | ', CASE WHEN NOT r1_poliza_vigente THEN 'Póliza no vigente' END,
                     CASE WHEN NOT r2_monto_razonable THEN 'Monto excesivo' END,
                     CASE WHEN NOT r4_prediccion_confiable THEN 'Predicción no confiable' END,
                     CASE WHEN NOT r5_coherencia_severidad THEN 'Severidad incoherente' END) AS motivos_revision
    FROM counted)"""


def rollup(t: Tables, vehicles: bool = True):
    """Image names are unique in the metadata and none is hot, so both sides join on the partitioning they have."""
    return plan.prediction_rollup(t.standin("predictions"), cleaning.metadata(t, vehicles))


def joined(t: Tables):
    return plan.claim_policy_customer(cleaning.claims(t), cleaning.policies(t), cleaning.customers(t))


def decided(t: Tables, predictions: bool = True):
    """Decision table without customer columns, which no rule or panel reads; customers are joined, as repeated ones repeat claims."""
    rolled = rollup(t, vehicles=False) if predictions else None
    base = plan.decision_base(cleaning.claims(t), cleaning.policies(t), cleaning.customers(t), rolled)
    return plan.decide(base.drop("first_name", "last_name", "date_of_birth"))


@query("telematics_by_vehicle", f"WITH {VEHICLES} SELECT * FROM vehicles")
def telematics_by_vehicle(t: Tables):
    return plan.telematics_by_vehicle(cleaning.telematics(t))


query("prediction_rollup", f"WITH {ROLLUP} SELECT * FROM rollup_")(rollup)
query("claim_policy_customer", f"WITH {JOINED} SELECT * FROM joined")(joined)


@query(
    "claim_telematics",
    f"WITH {JOINED}, {VEHICLES} SELECT joined.*, vehicles.* EXCLUDE (chassis_no) FROM joined LEFT JOIN vehicles "
    "ON joined.chassis_no = vehicles.chassis_no",
)
def claim_telematics(t: Tables):
    return plan.claim_telematics(joined(t), unpartitioned(telematics_by_vehicle(t)))


@query(
    "claims_without_telematics",
    f"WITH {JOINED}, {VEHICLES} SELECT claim_no, chassis_no FROM joined "
    "WHERE chassis_no NOT IN (SELECT chassis_no FROM vehicles WHERE avg_speed IS NOT NULL)",
)
def claims_without_telematics(t: Tables):
    return claim_telematics(t).filter("avg_speed IS NULL").select("claim_no", "chassis_no")


@query("decision_base", f"WITH {BASE} SELECT * FROM base")
def decision_base(t: Tables):
    return plan.decision_base(cleaning.claims(t), cleaning.policies(t), cleaning.customers(t), rollup(t, vehicles=False))


@query(
    "optional_predictions",
    f"WITH {cleaning.CLAIMS} SELECT claim_no, CAST(NULL AS VARCHAR) AS damage_label, "
    "CAST(NULL AS DOUBLE) AS damage_score, CAST(NULL AS BIGINT) AS total_imagenes FROM claims_clean",
)
def optional_predictions(t: Tables):
    """No predictions table lies next to the given tables, so the typed empty one is used."""
    gold = Layer(t.spark, "gold", root=t.folder)
    rolled = gold.read_or_empty("claim_predictions", schemas.CLAIM_PREDICTIONS)
    base = plan.decision_base(cleaning.claims(t), cleaning.policies(t), rollup=rolled)
    return base.select("claim_no", "damage_label", "damage_score", "total_imagenes")


@query(
    "present_predictions",
    f"WITH {BASE} SELECT claim_no, damage_label, damage_score, confidence_level, total_imagenes FROM base",
)
def present_predictions(t: Tables):
    """The predictions table lies in the layer, so it is joined."""
    gold = Layer(t.spark, "gold", new_shared_folder(t.spark))
    gold.write(rollup(t), "claim_predictions")
    rolled = gold.read_or_empty("claim_predictions", schemas.CLAIM_PREDICTIONS)
    base = plan.decision_base(cleaning.claims(t), cleaning.policies(t), rollup=rolled)
    return base.select("claim_no", "damage_label", "damage_score", "confidence_level", "total_imagenes")


_WEIGHTS = tuple((v, i + 1) for i, v in enumerate(SEVERITIES))


@query(
    "literal_weights",
    f"WITH {cleaning.CLAIMS}, w(severity, weight) AS (VALUES {', '.join(str(w) for w in _WEIGHTS)}) "
    "SELECT severity, CAST(weight AS INTEGER) AS weight, count(claim_no) AS n, CAST(count(claim_no) * weight AS BIGINT) AS weighted "
    "FROM w LEFT JOIN claims_clean USING (severity) GROUP BY severity, weight",
)
def literal_weights(t: Tables):
    """A table of literal rows joined with counts of claims."""
    weights = schemas.literal_rows(t.spark, {"severity": "string", "weight": "int"}, _WEIGHTS)
    found = cleaning.claims(t).groupBy("severity").agg(F.count("claim_no").alias("n"))
    counted = weights.join(found, "severity", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.withColumn("weighted", F.col("n") * F.col("weight"))


@query(
    "image_metadata_coverage",
    f"WITH {raw('predictions')}, {cleaning.METADATA} SELECT (SELECT count(*) FROM predictions) AS left_rows, "
    "(SELECT count(*) FROM metadata_clean) AS right_rows, "
    "(SELECT count(*) FROM predictions JOIN metadata_clean USING (image_name)) AS joined_rows, "
    "(SELECT count(*) FROM predictions ANTI JOIN metadata_clean USING (image_name)) AS left_unmatched, "
    "(SELECT count(*) FROM metadata_clean ANTI JOIN predictions USING (image_name)) AS right_unmatched, "
    "(SELECT count(*) FROM (SELECT image_name FROM predictions JOIN metadata_clean USING (image_name) "
    "GROUP BY image_name HAVING count(DISTINCT metadata_clean.image_id) > 1)) AS fanout_keys",
)
def image_metadata_coverage(t: Tables):
    return join_audit(t.standin("predictions"), F.col("image_name"), cleaning.metadata(t), F.col("image_name"))


@query("claim_decisions", f"WITH {DECIDED} SELECT * FROM decided")
def claim_decisions(t: Tables):
    return plan.decide(decision_base(t))


@query("decision_counts", f"WITH {DECIDED} SELECT decision_final, count(*) AS n FROM decided GROUP BY decision_final")
def decision_counts(t: Tables):
    return decided(t).groupBy("decision_final").agg(F.count(F.lit(1)).alias("n")).orderBy("decision_final")




@query("star_join_buckets", f"WITH {JOINED} SELECT * FROM joined")
def star_join_buckets(t: Tables):
    """Claims and insured policies written bucketed by policy, so that their join has no exchange."""
    lake = Layer(t.spark, f"estrato_{uuid.uuid4().hex}")
    count = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    dimension = plan.insured(cleaning.policies(t), cleaning.customers(t)).repartition(count, "_policy")
    facts = cleaning.claims(t).repartition(count, "policy_no")
    insured = lake.write(dimension, "insured_policies", bucket_by=(count, ["_policy"]))
    return plan.claim_policy(lake.write(facts, "claims_clean", bucket_by=(count, ["policy_no"])), insured)


_SILVER_SQL = {
    "customers_clean": ("customers_typed", "date_of_birth IS NOT NULL AND trim(name) <> '' AND first_name <> '' AND last_name <> ''"),
    "policies_clean": ("policies", "POLICY_NO IS NOT NULL AND CUST_ID IS NOT NULL AND PREMIUM >= 0 AND POL_EFF_DATE <= POL_EXPIRY_DATE"),
    "claims_clean": ("claims", "claim_no IS NOT NULL AND policy_no IS NOT NULL AND total >= 0 AND age > 0"),
    "telematics_clean": ("telematics", "chassis_no IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND speed >= 0"),
}
# A figure of each table that is not 0: rows in it, rows kept out, and rows without an optional value.
_OPTIONAL = {"customers_clean": "neighborhood IS NULL", "policies_clean": "PREMIUM < 1000", "claims_clean": "claim_date IS NULL", "telematics_clean": "speed > 50"}


@query(
    "written_figures",
    f"WITH {cleaning.CUSTOMERS}, {cleaning.POLICIES}, {cleaning.CLAIMS}, {cleaning.TELEMATICS} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, check_name, n FROM (SELECT 'filas' AS check_name, count(*) FILTER ({valid}) AS n FROM {source} UNION ALL "
        f"SELECT 'any_check', count(*) - count(*) FILTER ({valid}) FROM {source} UNION ALL "
        f"SELECT 'optional', count(*) FILTER (({valid}) AND ({_OPTIONAL[name]})) FROM {source})"
        for name, (source, valid) in _SILVER_SQL.items()
    ),
)
def written_figures(t: Tables):
    """Figures of silver tables, and rows that the checks kept out, counted while the tables are written."""
    clean, found = Layer(t.spark, "silver", new_shared_folder(t.spark)), []
    for name, (source, derive, checks, _) in plan.SILVER.items():
        rejects = Observation(f"rejects_{uuid.uuid4().hex}")
        rows = derive(t.standin(source)).observe(rejects, *reject_figures(checks))
        clean.write(keep_valid(rows, checks), name, figures={"filas": F.count(F.lit(1)), "optional": F.count_if(F.expr(_OPTIONAL[name]))})
        counted = clean.figures[name] | {"any_check": rejects.get["any_check"]}
        found += [(name, check, n) for check, n in counted.items()]
    return schemas.literal_rows(t.spark, FIGURES, found)
