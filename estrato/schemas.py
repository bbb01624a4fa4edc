"""Declared column types of the landing files and tables.

Landing CSV files are read as text and conformed to these types, so a malformed
value becomes NULL in one column instead of changing the column's type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VUELOS = {
    "vuelo_id": "string",
    "fecha": "date",
    "origen_id": "string",
    "destino_id": "string",
    "aeronave_id": "string",
    "estado": "string",
    "duracion_min": "int",
}
AEROPUERTOS = {
    "aeropuerto_id": "string",
    "nombre": "string",
    "ciudad": "string",
    "pais": "string",
    "lat": "double",
    "lon": "double",
}
AERONAVES = {
    "aeronave_id": "string",
    "modelo": "string",
    "fabricante": "string",
    "anio_fabricacion": "int",
}
MANTENIMIENTOS = {
    "mantenimiento_id": "string",
    "aeronave_id": "string",
    "fecha": "date",
    "tipo": "string",
    "costo_usd": "double",
    "duracion_hr": "double",
}

CUSTOMERS = {
    "customer_id": "bigint",
    "date_of_birth": "string",
    "name": "string",
    "borough": "string",
    "neighborhood": "string",
    "zip_code": "string",
}
POLICIES = {
    "POLICY_NO": "string",
    "CUST_ID": "bigint",
    "CHASSIS_NO": "string",
    "MAKE": "string",
    "MODEL": "string",
    "MODEL_YEAR": "int",
    "PREMIUM": "double",
    "POL_EFF_DATE": "date",
    "POL_EXPIRY_DATE": "date",
}
CLAIMS = {
    "claim_no": "string",
    "policy_no": "string",
    "claim_date": "date",
    "license_issue_date": "date",
    "total": "double",
    "age": "int",
    "type": "string",
    "collision_type": "string",
    "severity": "string",
    "hour": "int",
    "number_of_vehicles_involved": "int",
    "number_of_witnesses": "int",
    "injury": "string",
}
TELEMATICS = {
    "chassis_no": "string",
    "event_timestamp": "timestamp",
    "latitude": "double",
    "longitude": "double",
    "speed": "double",
}
IMAGE_METADATA = {
    "image_name": "string",
    "image_id": "string",
    "claim_no": "string",
    "chassis_no": "string",
}
PREDICTIONS = {
    "image_name": "string",
    "damage_label": "string",
    "damage_score": "double",
    "confidence_level": "string",
    "is_reliable": "boolean",
}
CLAIM_PREDICTIONS = {
    "claim_no": "string",
    "chassis_no": "string",
    "damage_label": "string",
    "damage_score": "double",
    "confidence_level": "string",
    "imagenes_confiables": "bigint",
    "total_imagenes": "bigint",
}

SALES = {
    "order_id": "string",
    "order_date": "date",
    "country": "string",
    "product": "string",
    "units_sold": "int",
    "unit_price": "double",
}
PRODUCTS = {
    "id": "string",
    "fecha": "string",
    "producto": "string",
    "cantidad": "int",
    "precio": "double",
}


def struct_of(types: dict[str, str]) -> T.StructType:
    """``StructType`` for a ``{column: type}`` declaration."""
    return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in types.items()))


def empty_table(spark: SparkSession, types: dict[str, str]) -> DataFrame:
    """No rows of the declared types; the optimizer drops joins with it."""
    one = spark.range(0, 1, 1, 1).select(*[F.lit(None).cast(t).alias(c) for c, t in types.items()])
    return one.filter(F.lit(False))


def literal_rows(spark: SparkSession, types: dict[str, str], rows: Sequence[tuple]) -> DataFrame:
    """A few rows given in the program, as literals of the plan."""
    if not rows:
        return empty_table(spark, types)
    structs = [F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, types.items())]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
