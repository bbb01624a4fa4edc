"""Dimension lookups, joins with hot keys, and join checks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.operators.dedup import unique_on
from estrato.operators.shape import require

SALTS = 64


def enrich(fact: DataFrame, dimension: DataFrame, on: Sequence[str], guard: bool = False) -> DataFrame:
    """Left join of a dimension, so every fact row stays.

    ``guard`` makes the query fail if the dimension repeats a key, which would
    multiply fact rows.  No broadcast is forced: Spark broadcasts a dimension
    below its size limit, and otherwise splits skewed partitions at run time; see
    ``unpartitioned`` for dimensions aggregated in the same query.
    """
    return fact.join(unique_on(dimension, on) if guard else dimension, list(on), "left")


def unpartitioned(df: DataFrame) -> DataFrame:
    """``df`` without the partitioning that an aggregate leaves behind.

    Spark joins on that partitioning as it is, and then cannot split the
    partition in which the other side has a hot key: run-time splitting needs
    shuffles of the join's own.  The price is two shuffles of this side, the
    smaller one.  Tables read from storage do not need it.
    """
    return df.hint("rebalance")


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that hold about ``share`` of all rows or more; at most ``1 / share`` of them.

    One pass with a sketch of bounded size, no shuffle by the key.  The counts are
    estimates, which is enough for a choice that only affects speed.
    """
    top = math.ceil(1 / share)
    sketch = F.expr(f"approx_top_k(`{key}`, {top}, {20 * top})")
    found = require(df, key).agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [item["item"] for item in found["top"] or () if item["count"] >= share * found["n"]]


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    hot: Sequence | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Inner or left join that spreads the hot keys of ``left`` over many tasks.

    Run-time skew splitting does not apply where the join's partitioning is
    needed later, or where it is off.  Here only the hot keys get a salt: a left
    row with a hot key joins on (key, one salt of its own), and the right rows of
    just those keys are repeated once per salt.  All other rows join on (key, 0).
    The result is that of the plain join, also for repeated keys on the right.
    ``hot`` names the keys if they are known, else ``hot_keys`` looks for them.

    The salt is a hash of the row, not a random number, so a task that is run
    again after a lost executor sends its rows to the same partitions.
    """
    if how not in ("inner", "left"):
        raise ValueError("split_join does inner and left joins")
    hot = hot_keys(left, on) if hot is None else hot
    is_hot = F.coalesce(F.col(on).isin(*hot), F.lit(False)) if hot else F.lit(False)
    row_hash = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    # Rows without a key match nothing, so they may go anywhere.
    left_salt = F.when(is_hot | F.col(on).isNull(), row_hash).otherwise(F.lit(0))
    right_salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn("_salt", left_salt)
    salted_right = right.withColumn("_salt", F.explode(right_salts))
    return salted_left.join(salted_right, [on, "_salt"], how).drop("_salt")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their number of rows; NULL is no key.

    Counting first means the join sees each key once, however often it occurs.
    """
    counts = require(child, child_key).groupBy(child_key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def join_audit(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column) -> DataFrame:
    """What a join on these keys does, as one row, without doing it.

    Both sides are reduced to a count per key, so neither a hot key nor a
    fan-out is ever materialised.
    """
    l_counts = left.groupBy(left_key.alias("k")).agg(F.count(F.lit(1)).alias("l"))
    r_counts = right.groupBy(right_key.alias("k")).agg(F.count(F.lit(1)).alias("r"))
    both = l_counts.join(r_counts, "k", "full_outer")
    matched = F.col("l").isNotNull() & F.col("r").isNotNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return both.agg(
        total(F.col("l")).alias("left_rows"),
        total(F.col("r")).alias("right_rows"),
        total(F.when(matched, F.col("l") * F.col("r"))).alias("joined_rows"),
        total(F.when(~matched, F.col("l"))).alias("left_unmatched"),
        total(F.when(~matched, F.col("r"))).alias("right_unmatched"),
        F.count_if(matched & (F.col("r") > 1)).alias("fanout_keys"),
    )
