"""Fixed values.

Results match only if these words, formats and limits are used literally, so
they are stated here once, in natural order, and referred to by name elsewhere.
"""

# Accepted birth date formats, first fit wins.
DATE_FORMATS = ("MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "yyyy/MM/dd")

# Flight states and the count column each one feeds.
FLIGHT_STATES = {
    "vuelos_a_tiempo": "a_tiempo",
    "vuelos_retrasados": "retrasado",
    "vuelos_cancelados": "cancelado",
}

# Reported damage classes, in report order.
SEVERITIES = ("Minor Damage", "Major Damage", "Total Loss", "Trivial Damage")
HEAVY_SEVERITIES = ("Major Damage", "Total Loss")
LIGHT_DAMAGE = ("scratch", "dent")

# Confidence levels with their lowest score, best first.
CONFIDENCE_LEVELS = (("alta", 0.8), ("media", 0.5), ("baja", 0.0))
RELIABLE_LEVELS = ("alta", "media")

# Decisions, in report order.
DECISIONS = ("LIBERADO", "REVISION_MENOR", "INVESTIGAR")

# Largest claim accepted, in premiums.
PREMIUM_MULTIPLE = 3

# Reason texts per rule.
REASONS = {
    "r1_poliza_vigente": "Póliza no vigente",
    "r2_monto_razonable": "Monto excesivo",
    "r3_reporte_policial": "Sin reporte policial",
    "r4_prediccion_confiable": "Predicción no confiable",
    "r5_coherencia_severidad": "Severidad incoherente",
    "r6_tiempo_razonable": "Tiempo excedido",
}

# Names shown for missing values.
NO_PREDICTION = "Sin predicción"
NO_LEVEL = "sin datos"
NO_DECISION = "SIN DECISIÓN"
NO_MONTH = "NaT"

# Names of what a prediction says about the reported severity.
COHERENT = "Coherente"
INCOHERENT = "Incoherente"

# Claim columns that others have replaced.
SUPERSEDED_CLAIM_COLUMNS = ("date", "date_1", "date_2")

# Policy columns under the names of the joined tables.
POLICY_COLUMNS = {
    "_policy": "POLICY_NO",
    "cust_id": "CUST_ID",
    "chassis_no": "CHASSIS_NO",
    "premium": "PREMIUM",
    "policy_start": "POL_EFF_DATE",
    "policy_end": "POL_EXPIRY_DATE",
    "auto_make": "MAKE",
    "auto_model": "MODEL",
    "auto_year": "MODEL_YEAR",
}

# Claim columns under the names of the decision table, and columns it has that no source fills.
INCIDENT = {
    "claim_no": "claim_no",
    "policy_no": "policy_no",
    "claim_date": "claim_date",
    "incident_date": "claim_date",
    "claim_total": "total",
    "incident_type": "type",
    "collision_type": "collision_type",
    "incident_severity": "severity",
    "incident_hour": "hour",
    "number_of_vehicles_involved": "number_of_vehicles_involved",
    "bodily_injuries": "injury",
    "witnesses": "number_of_witnesses",
}
UNKNOWN = ("authorities_contacted", "police_report_available")
