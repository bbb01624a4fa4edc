"""Sales tutorial tables: totals, countries, products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.operators.aggregates import grouped_sums
from estrato.operators.joins import enrich


def with_total(sales: DataFrame) -> DataFrame:
    return sales.withColumn("total_sales", F.col("units_sold") * F.col("unit_price"))


def by_country(sales: DataFrame) -> DataFrame:
    """Units and amount per country, largest amount first."""
    sums = grouped_sums(
        with_total(sales), ["country"], {"total_units": "units_sold", "total_sales_amount": "total_sales"}
    )
    return sums.orderBy(F.desc("total_sales_amount"), "country")


def with_product(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with product attributes; fails if the product table repeats a key."""
    return enrich(with_total(sales), products, ["product"], guard=True)


def average_price(products: DataFrame, product: str, min_price: float) -> DataFrame:
    chosen = (F.col("producto") == product) & (F.col("precio") >= min_price)
    return products.filter(chosen).agg(F.avg("precio").alias("precio_medio"))


def average_price_sql(spark: SparkSession, view: str, product: str, min_price: float) -> DataFrame:
    """The same with bound parameters; values never become part of the SQL text."""
    return spark.sql(
        "SELECT avg(precio) AS precio_medio FROM IDENTIFIER(:view) "
        "WHERE producto = :producto AND precio >= CAST(:min_price AS DOUBLE)",
        args={"view": view, "producto": product, "min_price": min_price},
    )
