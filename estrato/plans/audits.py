"""Audits of the silver claim tables: what must not be there after cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.operators.quality import audit_long, duplicate_keys


def _empty(column: str) -> str:
    return f"coalesce({column}, '') = ''"


# Names of the audit figures, per table.
SILVER_PROBLEMS = {
    "customers_clean": {
        "nulos_date_of_birth": "date_of_birth IS NULL",
        "nulos_name": _empty("name"),
        "nulos_first_name": _empty("first_name"),
        "nulos_last_name": _empty("last_name"),
        # The parts: the joined text has its separators and is never empty.
        "nulos_address": " AND ".join(f"{_empty(f'CAST({c} AS STRING)')}" for c in ("borough", "neighborhood", "zip_code")),
    },
    "policies_clean": {
        "nulos_POLICY_NO": "POLICY_NO IS NULL",
        "nulos_CUST_ID": "CUST_ID IS NULL",
        "nulos_PREMIUM": "PREMIUM IS NULL",
        "nulos_POL_EFF_DATE": "POL_EFF_DATE IS NULL",
        "nulos_POL_EXPIRY_DATE": "POL_EXPIRY_DATE IS NULL",
        "periodo_invertido": "POL_EFF_DATE > POL_EXPIRY_DATE",
    },
    "claims_clean": {
        "nulos_claim_no": "claim_no IS NULL",
        "nulos_policy_no": "policy_no IS NULL",
        "nulos_claim_date": "claim_date IS NULL",
        "nulos_license_issue_date": "license_issue_date IS NULL",
        "total_negativo": "total < 0",
        "age_invalida": "age <= 0",
    },
    "telematics_clean": {
        "nulos_chassis_no": "chassis_no IS NULL",
        "nulos_timestamp": "event_timestamp IS NULL",
        "nulos_latitude": "latitude IS NULL",
        "nulos_longitude": "longitude IS NULL",
        "latitud_invalida": "latitude NOT BETWEEN -90 AND 90",
        "longitud_invalida": "longitude NOT BETWEEN -180 AND 180",
        "velocidad_negativa": "speed < 0",
    },
    "training_images": {
        "nulos_path": "path IS NULL",
        "nulos_image_name": _empty("image_name"),
        "nulos_label": _empty("label"),
    },
    "claim_images": {
        "nulos_path": "path IS NULL",
        "nulos_image_name": _empty("image_name"),
    },
    "claim_images_metadata_clean": {
        "nulos_image_name": "image_name IS NULL",
        "nulos_claim_no": "claim_no IS NULL",
        "nulos_chassis_no": "chassis_no IS NULL",
    },
}


# The airline's silver tables; repeated keys are counted by ``repeated``.
AIRLINE_PROBLEMS = {
    "vuelos": {"nulos_vuelo_id": "vuelo_id IS NULL", "nulos_fecha": "fecha IS NULL"},
    "aeropuertos": {"nulos_aeropuerto_id": "aeropuerto_id IS NULL"},
    "aeronaves": {"nulos_aeronave_id": "aeronave_id IS NULL"},
    "mantenimientos": {"nulos_mantenimiento_id": "mantenimiento_id IS NULL"},
}
AIRLINE_KEYS = {"vuelos": "vuelo_id", "aeropuertos": "aeropuerto_id", "aeronaves": "aeronave_id", "mantenimientos": "mantenimiento_id"}


# Columns of audit figures.
FIGURES = {"table_name": "string", "check_name": "string", "n": "bigint"}


def audit_figures(table: str) -> dict[str, Column]:
    """The figures of a silver table as aggregates, to be taken while it is written."""
    return {name: F.count_if(F.expr(condition)) for name, condition in SILVER_PROBLEMS[table].items()}


def repeated(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """(table_name, check_name, n): keys of each table that several rows have; rows without a key count as of one key."""
    parts = [
        duplicate_keys(table, keys[name]).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit("claves_repetidas").alias("check_name"), "n")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def audit_airline(tables: dict[str, DataFrame]) -> DataFrame:
    """Missing and repeated keys of the airline's tables."""
    return audit_tables(tables, AIRLINE_PROBLEMS).unionByName(repeated(tables, AIRLINE_KEYS))


def audit_tables(tables: dict[str, DataFrame], problems: dict[str, dict[str, str]] = SILVER_PROBLEMS) -> DataFrame:
    """(table_name, check_name, n) for every figure of every given table.

    One aggregate per table, all in one job.
    """
    parts = [
        audit_long(table, problems[name]).select(F.lit(name).alias("table_name"), "check_name", "n")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
