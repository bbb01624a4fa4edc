"""Projections, filters, parameters and the sales tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato.functions.numbers import stable_round
from estrato.functions.sql import register_functions
from estrato.operators.exact import exact_sums
from estrato.operators.joins import split_join
from estrato.operators.shape import conform, in_range, ordered, require, require_text, role
from estrato.plans import airline, sales
from estrato.workload.registry import Tables, mean, query, raw, rounded, summed


@query("project_subset", f"WITH {raw('sales')} SELECT order_id, order_date, country, units_sold FROM sales")
def project_subset(t: Tables):
    return t.standin("sales").select("order_id", "order_date", "country", "units_sold")


@query(
    "role_dimension",
    f"WITH {raw('aeropuertos')} SELECT aeropuerto_id AS origen_id, nombre AS origen_nombre, "
    "ciudad AS origen_ciudad, pais AS origen_pais FROM aeropuertos",
)
def role_dimension(t: Tables):
    return role(t.standin("aeropuertos"), airline.ORIGIN)


@query(
    "computed_total",
    f"WITH {raw('sales')} SELECT order_id, product, units_sold, unit_price, "
    f"{rounded('units_sold * unit_price', 2)} AS total_sales FROM sales",
)
def computed_total(t: Tables):
    out = sales.with_total(t.standin("sales"))
    return out.select("order_id", "product", "units_sold", "unit_price", stable_round(F.col("total_sales"), 2).alias("total_sales"))


@query(
    "conform_types",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS quantity,
              CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
              CAST(NULL AS DOUBLE) AS absent
       FROM orders""",
)
def conform_types(t: Tables):
    texts = t.orders.selectExpr(
        "o_orderkey AS ID",
        "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_custkey AS STRING) END AS quantity",
        "CASE WHEN o_orderstatus = 'O' THEN 'n/a' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day",
    )
    return conform(texts, {"id": "string", "quantity": "int", "day": "date", "absent": "double"}, optional=["absent"])


@query("filter_eq", f"WITH {raw('sales')} SELECT * FROM sales WHERE country = 'Country 7'")
def filter_eq(t: Tables):
    return t.standin("sales").filter(F.col("country") == "Country 7")


@query("filter_gt", f"WITH {raw('sales')} SELECT * FROM sales WHERE units_sold > 3")
def filter_gt(t: Tables):
    return t.standin("sales").filter(F.col("units_sold") > 3)


@query(
    "geo_range_filter",
    f"WITH {raw('aeropuertos')} SELECT * FROM aeropuertos WHERE lat >= -90 AND lat <= 90 AND lon >= -180 AND lon <= 180",
)
def geo_range_filter(t: Tables):
    return t.standin("aeropuertos").filter(in_range("lat", -90, 90) & in_range("lon", -180, 180))


@query(
    "date_order_filter",
    f"WITH {raw('policies')} SELECT POLICY_NO, POL_EFF_DATE, POL_EXPIRY_DATE FROM policies "
    "WHERE POL_EFF_DATE <= POL_EXPIRY_DATE",
)
def date_order_filter(t: Tables):
    periods = t.standin("policies").select("POLICY_NO", "POL_EFF_DATE", "POL_EXPIRY_DATE")
    return periods.filter(ordered("POL_EFF_DATE", "POL_EXPIRY_DATE"))


@query(
    "required_values",
    f"WITH {raw('customers')} SELECT customer_id, neighborhood, zip_code FROM customers "
    "WHERE zip_code IS NOT NULL AND trim(coalesce(neighborhood, '')) <> ''",
)
def required_values(t: Tables):
    rows = t.standin("customers").select("customer_id", "neighborhood", "zip_code")
    return require_text(require(rows, "zip_code"), "neighborhood")


@query("view_filter_project", "SELECT p_partkey AS id, p_name AS letra FROM part WHERE p_size > 15")
def view_filter_project(t: Tables):
    t.part.createOrReplaceTempView("estrato_part")
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY VIEW estrato_vw_part AS "
        "SELECT p_partkey AS id, p_name AS letra FROM estrato_part WHERE p_size > 15"
    )
    return t.spark.table("estrato_vw_part")


@query("sql_function_filter", "SELECT p_partkey AS id, p_name AS letra, p_size AS valor FROM part WHERE p_size > 12")
def sql_function_filter(t: Tables):
    register_functions(t.spark)
    table = t.part.selectExpr("p_partkey AS id", "p_name AS letra", "p_size AS valor")
    return table.filter("fn_mayor_que_10(valor)")


@query(
    "avg_price_param",
    f"WITH {raw('productos')} SELECT {mean('precio', 4)} AS precio_medio FROM productos "
    "WHERE producto = '2-HIGH' AND precio >= 1500",
)
def avg_price_param(t: Tables):
    t.standin("productos").createOrReplaceTempView("estrato_productos")
    out = sales.average_price_sql(t.spark, "estrato_productos", "2-HIGH", 1500.0)
    return out.select(stable_round(F.col("precio_medio"), 4).alias("precio_medio"))


@query(
    "avg_price_frame",
    f"WITH {raw('productos')} SELECT {mean('precio', 4)} AS precio_medio FROM productos "
    "WHERE producto = '1-URGENT' AND precio >= 2000",
)
def avg_price_frame(t: Tables):
    out = sales.average_price(t.standin("productos"), "1-URGENT", 2000.0)
    return out.select(stable_round(F.col("precio_medio"), 4).alias("precio_medio"))


@query("distinct_values", f"WITH {raw('productos')} SELECT DISTINCT producto FROM productos")
def distinct_values(t: Tables):
    return t.standin("productos").select("producto").distinct()


_COUNTRY_SQL = (
    f"WITH {raw('sales')} SELECT country, CAST(sum(units_sold) AS BIGINT) AS total_units, "
    f"{summed('units_sold * unit_price')} AS total_sales_amount FROM sales GROUP BY country"
)


def _country(t: Tables):
    return sales.by_country(t.standin("sales")).withColumn(
        "total_sales_amount", stable_round(F.col("total_sales_amount"), 2)
    )


@query("sales_by_country", _COUNTRY_SQL)
def sales_by_country(t: Tables):
    return _country(t)


@query("sales_by_country_sorted", _COUNTRY_SQL + " ORDER BY total_sales_amount DESC, country")
def sales_by_country_sorted(t: Tables):
    return _country(t).orderBy(F.desc("total_sales_amount"), "country")


_ENRICHED_SQL = (
    f"WITH {raw('sales')}, {raw('products')} SELECT product, order_id, order_date, country, units_sold, unit_price, "
    f"{rounded('units_sold * unit_price', 2)} AS total_sales, category, brand FROM sales LEFT JOIN products USING (product)"
)


@query("sales_enriched", _ENRICHED_SQL)
def sales_enriched(t: Tables):
    out = sales.with_product(t.standin("sales"), t.standin("products"))
    return out.withColumn("total_sales", stable_round(F.col("total_sales"), 2))


@query("sales_enriched_hot_keys", _ENRICHED_SQL)
def sales_enriched_hot_keys(t: Tables):
    out = split_join(sales.with_total(t.standin("sales")), t.standin("products"), "product")
    return out.withColumn("total_sales", stable_round(F.col("total_sales"), 2))


# Prices around 1e-16, 1e23 and as they are: the texts differ in the exponent only, so the sums do too.
_SCALES = {0: "E-16", 1: "E23", 2: ""}


@query(
    "sums_of_any_magnitude",
    "WITH s AS (SELECT l_linenumber % 3 AS scale, sum(CAST(l_extendedprice AS DECIMAL(38,2))) AS total, count(*) AS n FROM lineitem GROUP BY 1) "
    "SELECT CAST(scale AS INTEGER) AS scale, CAST(CAST(total AS VARCHAR) || CASE scale "
    + " ".join(f"WHEN {k} THEN '{e}'" for k, e in _SCALES.items())
    + " END AS DOUBLE) AS total, n FROM s",
)
def sums_of_any_magnitude(t: Tables):
    scale = F.col("l_linenumber") % 3
    text = F.concat(F.col("l_extendedprice").cast("string"), F.get(F.array(*[F.lit(e) for e in _SCALES.values()]), scale.cast("int")))
    return exact_sums(t.lineitem.select(scale.cast("int").alias("scale"), text.cast("double").alias("price")), ["scale"], {"total": "price"}, {"n": ("count", "price")})
