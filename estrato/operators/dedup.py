"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedup_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """Keep the row with the greatest (``keep="first"``: smallest) ``order``.

    Ties are broken by the remaining columns in schema order, so the survivor is
    the same for any partitioning.  NULL sorts below every value, and rows with
    a NULL key form one group.

    Spark limits each group to its first row in every task, before the shuffle
    (``WindowGroupLimit``), so a key holding a third of the table sends one row
    per task.  On wide rows this sorts once where a maximum over a struct of the
    row would build and compare structs.
    """
    others = [c for c in df.columns if c not in keys and c not in order]
    side = F.desc_nulls_last if keep == "last" else F.asc_nulls_first
    by = W.partitionBy(*keys).orderBy(*[side(c) for c in ([*order, *others] or keys)])
    return df.withColumn("_rank", F.row_number().over(by)).filter("_rank = 1").drop("_rank")


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, but the query fails if a key occurs twice.

    The check is a scalar subquery over counts per key, next to the rows and not
    in their way: a join on ``df`` still shuffles the rows itself, which lets
    Spark split a skewed partition of the other side.
    """
    most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).scalar()
    message = F.concat(F.lit(f"key ({', '.join(keys)}) repeats "), most.cast("string"), F.lit(" times"))
    return df.filter(F.when(most > 1, F.raise_error(message).cast("boolean")).otherwise(True))
