"""Airline tables and KPIs."""

from __future__ import annotations

from estrato.operators.joins import unpartitioned
from estrato.plans import airline as plan
from estrato.workload.registry import Tables, best_row, mean, pct, query, raw, summed
from estrato.workload.standins import columns

FLIGHTS = f"{raw('vuelos')}, flights AS ({best_row('vuelos', columns('vuelos'), ['vuelo_id'], ['fecha'])})"
AIRPORTS = (
    f"{raw('aeropuertos')}, airports_ok AS (SELECT * FROM aeropuertos WHERE lat BETWEEN -90 AND 90 "
    "AND lon BETWEEN -180 AND 180), airports AS "
    f"({best_row('airports_ok', columns('aeropuertos'), ['aeropuerto_id'], ['nombre'])})"
)
AIRCRAFT = (
    f"{raw('aeronaves')}, aircraft_ok AS (SELECT * FROM aeronaves WHERE anio_fabricacion IS NOT NULL), aircraft AS "
    f"({best_row('aircraft_ok', columns('aeronaves'), ['aeronave_id'], ['anio_fabricacion'])})"
)
JOBS = (
    f"{raw('mantenimientos')}, jobs AS "
    f"({best_row('mantenimientos', columns('mantenimientos'), ['mantenimiento_id'], ['fecha'])})"
)
ENRICHED = f"""{FLIGHTS}, {AIRPORTS}, {AIRCRAFT}, enriched AS (
    SELECT f.*, nombre AS origen_nombre, ciudad AS origen_ciudad, pais AS origen_pais, modelo, fabricante,
           anio_fabricacion, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes
    FROM flights f LEFT JOIN airports a ON f.origen_id = a.aeropuerto_id
                   LEFT JOIN aircraft c ON f.aeronave_id = c.aeronave_id)"""


def flights(t: Tables):
    return plan.silver_flights(t.standin("vuelos"))


def airports(t: Tables):
    return plan.silver_airports(t.standin("aeropuertos"))


def aircraft(t: Tables):
    return plan.silver_aircraft(t.standin("aeronaves"))


def dimensions(t: Tables):
    return unpartitioned(airports(t)), unpartitioned(aircraft(t))


def jobs(t: Tables):
    return plan.silver_maintenance(t.standin("mantenimientos"))


query("silver_flights", f"WITH {FLIGHTS} SELECT * FROM flights")(flights)
query("silver_airports", f"WITH {AIRPORTS} SELECT * FROM airports")(airports)
query("silver_aircraft", f"WITH {AIRCRAFT} SELECT * FROM aircraft")(aircraft)
query("silver_maintenance", f"WITH {JOBS} SELECT * FROM jobs")(jobs)


@query("flight_enriched", f"WITH {ENRICHED} SELECT * FROM enriched")
def flight_enriched(t: Tables):
    return plan.flights_enriched(flights(t), *dimensions(t))


@query(
    "kpi_punctuality",
    f"""WITH {ENRICHED}, kpi AS (
        SELECT modelo, fabricante, origen_pais, mes, anio, count(vuelo_id) AS total_vuelos,
               count(*) FILTER (estado = 'a_tiempo') AS vuelos_a_tiempo,
               count(*) FILTER (estado = 'retrasado') AS vuelos_retrasados,
               count(*) FILTER (estado = 'cancelado') AS vuelos_cancelados,
               {mean('duracion_min', 2)} AS duracaion_promedio_min
        FROM enriched GROUP BY modelo, fabricante, origen_pais, mes, anio)
    SELECT *, {pct('vuelos_a_tiempo', 'total_vuelos')} AS puntualidad_pct FROM kpi""",
)
def kpi_punctuality(t: Tables):
    return plan.kpi_punctuality(flights(t), *dimensions(t))


@query(
    "kpi_maintenance",
    f"""WITH {JOBS}, {AIRCRAFT}
    SELECT j.aeronave_id, modelo, fabricante, tipo, CAST(month(fecha) AS INTEGER) AS mes,
           CAST(year(fecha) AS INTEGER) AS anio, count(mantenimiento_id) AS total_mantenimientos,
           {mean('costo_usd', 2)} AS costo_promedio_usd, {summed('costo_usd')} AS costo_total_usd,
           {mean('duracion_hr', 2)} AS duracion_promedio_hr,
           {summed('duracion_hr')} AS duracion_total_hr
    FROM jobs j LEFT JOIN aircraft a ON j.aeronave_id = a.aeronave_id
    GROUP BY j.aeronave_id, modelo, fabricante, tipo, month(fecha), year(fecha)""",
)
def kpi_maintenance(t: Tables):
    return plan.kpi_maintenance(jobs(t), aircraft(t))
