"""Named SQL predicate functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed value: the threshold is 12 although the name says 10.
MAYOR_QUE_10_LIMIT = 12


def register_functions(spark: SparkSession) -> None:
    """Create the SQL functions; the optimizer inlines their bodies."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION fn_mayor_que_10(x DOUBLE) "
        f"RETURNS BOOLEAN RETURN x > {MAYOR_QUE_10_LIMIT}"
    )
