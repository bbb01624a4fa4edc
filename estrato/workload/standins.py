"""Stand-in tables: the domain tables expressed over the given tables.

Each entry is (source table, {column: expression}, row condition).  The
expressions only rename and recode, in SQL both engines read the same way; what
the operators do with the columns is written separately on both sides.  Values
that checks must reject (missing names, negative premiums, positions off the
globe, malformed text) come from recoded values of the source.
"""

from __future__ import annotations

_BORN = "(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT))"
_DAY, _MONTH, _YEAR = (
    f"lpad(CAST(day({_BORN}) AS STRING), 2, '0')",
    f"lpad(CAST(month({_BORN}) AS STRING), 2, '0')",
    f"CAST(year({_BORN}) AS STRING)",
)
_CLAIM_NO = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
_IMAGE = (
    "'damage_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || "
    "CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) || '.jpg'"
)

STANDINS: dict[str, tuple[str, dict[str, str], str | None]] = {
    # --- airline
    "vuelos": (
        "lineitem",
        {
            "vuelo_id": _CLAIM_NO,
            "fecha": "CAST(l_shipdate AS DATE)",
            "origen_id": "CAST(l_suppkey AS STRING)",
            "destino_id": "CAST(l_orderkey AS STRING)",
            "aeronave_id": "CAST(l_partkey AS STRING)",
            "estado": "CASE l_returnflag WHEN 'A' THEN 'a_tiempo' WHEN 'N' THEN 'retrasado' ELSE 'cancelado' END",
            "duracion_min": "CAST(l_quantity AS INT)",
        },
        None,
    ),
    "aeropuertos": (
        "supplier",
        {
            "aeropuerto_id": "CAST(s_suppkey AS STRING)",
            "nombre": "s_name",
            "ciudad": "'City ' || CAST(s_nationkey AS STRING)",
            "pais": "'Country ' || CAST(s_nationkey AS STRING)",
            "lat": "s_acctbal / 100",
            "lon": "CAST(s_nationkey AS DOUBLE) * 15 - 175",
        },
        None,
    ),
    "aeronaves": (
        "part",
        {
            "aeronave_id": "CAST(p_partkey AS STRING)",
            "modelo": "p_type",
            "fabricante": "p_brand",
            "anio_fabricacion": "CASE WHEN p_size = 1 THEN NULL ELSE 1970 + p_size END",
        },
        None,
    ),
    "mantenimientos": (
        "lineitem",
        {
            "mantenimiento_id": f"{_CLAIM_NO} || '-' || l_linestatus",
            "aeronave_id": "CAST(l_partkey AS STRING)",
            "fecha": "CAST(l_shipdate AS DATE)",
            "tipo": "l_returnflag",
            "costo_usd": "l_extendedprice",
            "duracion_hr": "l_quantity",
        },
        None,
    ),
    # --- claims
    "customers": (
        "customer",
        {
            "customer_id": "c_custkey",
            "date_of_birth": (
                f"CASE c_mktsegment WHEN 'AUTOMOBILE' THEN {_MONTH} || '/' || {_DAY} || '/' || {_YEAR} "
                f"WHEN 'BUILDING' THEN {_DAY} || '/' || {_MONTH} || '/' || {_YEAR} "
                f"WHEN 'FURNITURE' THEN {_YEAR} || '-' || {_MONTH} || '-' || {_DAY} "
                f"WHEN 'HOUSEHOLD' THEN {_DAY} || '-' || {_MONTH} || '-' || {_YEAR} "
                f"ELSE CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE {_YEAR} || '/' || {_MONTH} || '/' || {_DAY} END END"
            ),
            "name": "CASE WHEN c_nationkey = 0 THEN c_name ELSE ' ' || c_mktsegment || ', ' || c_name END",
            "borough": "c_mktsegment",
            "neighborhood": "CASE WHEN c_nationkey = 1 THEN NULL ELSE 'District ' || CAST(c_nationkey AS STRING) END",
            "zip_code": "CASE WHEN c_acctbal < 0 THEN NULL ELSE 10000 + c_nationkey END",
        },
        None,
    ),
    "policies": (
        "orders",
        {
            "POLICY_NO": "CAST(o_orderkey AS STRING)",
            "CUST_ID": "o_custkey",
            "CHASSIS_NO": "CAST(o_custkey AS STRING)",
            "MAKE": "'Make ' || CAST(day(o_orderdate) AS STRING)",
            "MODEL": "o_orderpriority",
            "MODEL_YEAR": "CAST(year(o_orderdate) AS INT)",
            "PREMIUM": "(o_totalprice - 5000) / 10",
            "POL_EFF_DATE": "CAST(o_orderdate AS DATE)",
            "POL_EXPIRY_DATE": "CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 500) - 30 AS INT)",
        },
        None,
    ),
    "claims": (
        "lineitem",
        {
            "claim_no": _CLAIM_NO,
            "policy_no": "CAST(l_orderkey AS STRING)",
            "claim_date": "CASE WHEN l_discount = 0.1 THEN NULL ELSE CAST(l_shipdate AS DATE) END",
            "license_issue_date": "CAST(l_shipdate AS DATE) - CAST(l_quantity AS INT)",
            "total": "l_extendedprice - 2000",
            "age": "CAST(l_quantity AS INT) - 2",
            "type": "CASE l_returnflag WHEN 'A' THEN 'Collision' WHEN 'N' THEN 'Theft' ELSE NULL END",
            "collision_type": "l_linestatus",
            "severity": (
                "CASE l_linenumber WHEN 1 THEN 'Trivial Damage' WHEN 2 THEN 'Minor Damage' WHEN 3 THEN 'Minor Damage' "
                "WHEN 4 THEN 'Major Damage' WHEN 5 THEN 'Total Loss' WHEN 6 THEN 'Unknown' ELSE NULL END"
            ),
            "hour": "CASE WHEN l_tax = 0 THEN NULL ELSE CAST(floor(l_quantity * 24 / 51) AS INT) END",
            "number_of_vehicles_involved": "l_linenumber",
            "number_of_witnesses": "CAST(floor(l_discount * 100) AS INT)",
            "injury": "l_linestatus",
        },
        None,
    ),
    "telematics": (
        "events",
        {
            "chassis_no": "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS STRING) END",
            "event_timestamp": "ts",
            "latitude": "value - 30",
            "longitude": "value * 2 - 60",
            "speed": "value - 5",
        },
        None,
    ),
    # Photographs of open lines are filed under other names in the two tables: neither finds the other.
    "metadata": (
        "lineitem",
        {
            "image_name": f"CASE WHEN l_linestatus = 'F' THEN {_IMAGE} ELSE 'archivo_' || {_IMAGE} END",
            "image_id": "CAST(l_partkey AS STRING)",
            "claim_no": _CLAIM_NO,
            "chassis_no": "CAST(l_suppkey AS STRING)",
        },
        None,
    ),
    "predictions": (
        "lineitem",
        {
            "image_name": f"CASE WHEN l_linestatus = 'F' THEN {_IMAGE} ELSE 'sin_ficha_' || {_IMAGE} END",
            "damage_label": "CASE l_returnflag WHEN 'A' THEN 'scratch' WHEN 'N' THEN 'dent' ELSE 'broken_glass' END",
            "damage_score": "l_discount * 10",
            "confidence_level": (
                "CASE WHEN l_discount * 10 >= 0.8 THEN 'alta' WHEN l_discount * 10 >= 0.5 THEN 'media' ELSE 'baja' END"
            ),
            "is_reliable": "l_discount * 10 >= 0.5",
        },
        None,
    ),
    # --- tutorial
    "sales": (
        "lineitem",
        {
            "order_id": "CAST(l_orderkey AS STRING)",
            "order_date": "CAST(l_shipdate AS DATE)",
            "country": "'Country ' || CAST(l_suppkey AS STRING)",
            "product": "CAST(l_partkey AS STRING)",
            "units_sold": "CAST(l_quantity AS INT)",
            "unit_price": "l_extendedprice",
        },
        None,
    ),
    # Parts of the largest size are in the product table under another number.
    "products": (
        "part",
        {
            "product": "CASE WHEN p_size < 50 THEN CAST(p_partkey AS STRING) ELSE 'P' || CAST(p_partkey AS STRING) END",
            "category": "p_type",
            "brand": "p_brand",
        },
        None,
    ),
    "productos": (
        "orders",
        {
            "id": "CAST(o_orderkey AS STRING)",
            "fecha": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
            "producto": "o_orderpriority",
            "cantidad": "CAST(day(o_orderdate) AS INT)",
            "precio": "o_totalprice",
        },
        None,
    ),
    # --- labelled data
    "images": (
        "pages",
        {"path": "url", "content": "html"},
        None,
    ),
}


def columns(name: str) -> list[str]:
    return list(STANDINS[name][1])
