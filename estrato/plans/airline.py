"""Airline maintenance: flights, airports, aircraft, maintenance to two KPI tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato import schemas
from estrato.fixed import FLIGHT_STATES
from estrato.functions.numbers import percent, stable_mean, stable_round, stable_sum
from estrato.operators.aggregates import state_counts
from estrato.operators.dedup import dedup_by
from estrato.operators.joins import enrich
from estrato.operators.quality import expect_types
from estrato.operators.shape import Check, conform, keep_valid, role
from estrato.plans.audits import audit_airline
from estrato.sources.landing import read_landing
from estrato.sources.layers import Layer, stamp

TABLES = {
    "vuelos": schemas.VUELOS,
    "aeronaves": schemas.AERONAVES,
    "aeropuertos": schemas.AEROPUERTOS,
    "mantenimientos": schemas.MANTENIMIENTOS,
}
AIRPORT_CHECKS = (
    Check("lat_valid", "lat BETWEEN -90 AND 90"),
    Check("lon_valid", "lon BETWEEN -180 AND 180"),
)
AIRCRAFT_CHECKS = (Check("year_present", "anio_fabricacion IS NOT NULL"),)
# Airport columns in their role as origin of a flight.
ORIGIN = {
    "origen_id": "aeropuerto_id",
    "origen_nombre": "nombre",
    "origen_ciudad": "ciudad",
    "origen_pais": "pais",
}


def silver_flights(vuelos: DataFrame) -> DataFrame:
    """Typed flights, the latest row per flight."""
    return dedup_by(conform(vuelos, schemas.VUELOS, keep_rest=False), ["vuelo_id"], ["fecha"])


def silver_airports(aeropuertos: DataFrame) -> DataFrame:
    """Airports with coordinates on the globe, one row each."""
    typed = conform(aeropuertos, schemas.AEROPUERTOS, keep_rest=False)
    return dedup_by(keep_valid(typed, AIRPORT_CHECKS), ["aeropuerto_id"], ["nombre"])


def silver_aircraft(aeronaves: DataFrame) -> DataFrame:
    """Aircraft with a year of construction, one row each."""
    typed = conform(aeronaves, schemas.AERONAVES, keep_rest=False)
    return dedup_by(keep_valid(typed, AIRCRAFT_CHECKS), ["aeronave_id"], ["anio_fabricacion"])


def silver_maintenance(mantenimientos: DataFrame) -> DataFrame:
    """Typed maintenance jobs, the latest row per job."""
    typed = conform(mantenimientos, schemas.MANTENIMIENTOS, keep_rest=False)
    return dedup_by(typed, ["mantenimiento_id"], ["fecha"])


def flights_enriched(flights: DataFrame, airports: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Flights with their airport of origin, aircraft, year and month."""
    located = enrich(flights, role(airports, ORIGIN), ["origen_id"])
    return enrich(located, aircraft, ["aeronave_id"]).withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})


def kpi_punctuality(flights: DataFrame, airports: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Flights per state, mean duration and share on time, by model, maker, country, month.

    Country, model and maker follow from the flight's keys, so flights are counted per pair of keys and month first:
    a hot airport is combined before any shuffle, and both joins see counts, not flights.
    """
    month = [F.month("fecha").alias("mes"), F.year("fecha").alias("anio")]
    first = flights.groupBy("origen_id", "aeronave_id", *month).agg(
        F.count("vuelo_id").alias("total_vuelos"),
        *state_counts("estado", FLIGHT_STATES),
        F.sum("duracion_min").alias("_minutes"),
        F.count("duracion_min").alias("_timed"),
    )
    located = enrich(first, role(airports, {"origen_id": "aeropuerto_id", "origen_pais": "pais"}), ["origen_id"])
    named = enrich(located, aircraft.select("aeronave_id", "modelo", "fabricante"), ["aeronave_id"])
    summed = [F.sum(c).alias(c) for c in ("total_vuelos", *FLIGHT_STATES)]
    mean = stable_round(F.try_divide(F.sum("_minutes").cast("double"), F.sum("_timed")), 2)
    out = named.groupBy("modelo", "fabricante", "origen_pais", "mes", "anio").agg(*summed, mean.alias("duracaion_promedio_min"))
    return out.withColumn("puntualidad_pct", percent(F.col("vuelos_a_tiempo"), F.col("total_vuelos")))


def kpi_maintenance(maintenance: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Jobs, cost and hours by aircraft, type and month.

    Model and maker follow from the aircraft, so the jobs are aggregated first:
    an aircraft holding a third of all jobs is combined before any shuffle, and
    the join sees one row per group instead of every job.
    """
    measures = {"costo": ("costo_usd", "usd"), "duracion": ("duracion_hr", "hr")}
    out = [F.count("mantenimiento_id").alias("total_mantenimientos")]
    for name, (column, unit) in measures.items():
        out += [
            stable_mean(F.col(column), 2).alias(f"{name}_promedio_{unit}"),
            F.when(F.count(column) > 0, stable_sum(F.col(column), 2)).alias(f"{name}_total_{unit}"),
        ]
    grouped = maintenance.groupBy(
        "aeronave_id", "tipo", F.month("fecha").alias("mes"), F.year("fecha").alias("anio")
    ).agg(*out)
    return enrich(grouped, aircraft.select("aeronave_id", "modelo", "fabricante"), ["aeronave_id"])


def bronze(spark: SparkSession, landing: dict[str, str], layer: Layer) -> None:
    """Landing CSV files (``{table: path}``) to typed, stamped tables."""
    for table, types in TABLES.items():
        expect_types(layer.write(stamp(conform(read_landing(spark, landing[table]), types)), table), types)


def run(spark: SparkSession, landing: dict[str, str], root: str | None = None) -> dict[str, DataFrame]:
    """All layers; each step reads the tables the one before has written."""
    raw, clean, gold = (Layer(spark, name, root) for name in ("bronze", "silver", "gold"))
    bronze(spark, landing, raw)
    flights = clean.write(silver_flights(raw.read("vuelos")), "vuelos")
    airports = clean.write(silver_airports(raw.read("aeropuertos")), "aeropuertos")
    aircraft = clean.write(silver_aircraft(raw.read("aeronaves")), "aeronaves")
    jobs = clean.write(silver_maintenance(raw.read("mantenimientos")), "mantenimientos")
    tables = {"vuelos": flights, "aeropuertos": airports, "aeronaves": aircraft, "mantenimientos": jobs}
    return {
        "silver_audit": gold.write(audit_airline(tables), "silver_audit"),
        "kpi_puntualidad_vuelos": gold.write(
            kpi_punctuality(flights, airports, aircraft), "kpi_puntualidad_vuelos", partition_by=("anio", "mes")
        ),
        "kpi_costo_mantenimiento": gold.write(
            kpi_maintenance(jobs, aircraft), "kpi_costo_mantenimiento", partition_by=("anio", "mes")
        ),
    }
