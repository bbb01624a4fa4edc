"""Label dictionaries, splits, vectors, predictions and accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from estrato.fixed import CONFIDENCE_LEVELS, RELIABLE_LEVELS
from estrato.functions.numbers import banded, percent, stable_round
from estrato.operators.aggregates import n_rows
from estrato.operators.shape import require
from estrato.session import cut_lineage


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels with ids 0, 1, ... in label order, as (label_id, label).

    The distinct labels are written in ranges of about equal size, whatever they
    start with.  Ids are counted inside a range and shifted by the ranges before,
    so no task sees all labels.
    """
    labels = require(df, label).select(F.col(label).cast("string").alias("label")).distinct()
    ranged = cut_lineage(labels.repartitionByRange("label").withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(n_rows().alias("_n"))
    # One row per range: bounded by the number of shuffle partitions.
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(W.partitionBy("_range").orderBy("label"))
    return ranged.join(offsets, "_range").select((F.col("_offset") + within - 1).cast("int").alias("label_id"), "label")


def encode_labels(df: DataFrame, label: str, index: DataFrame, alias: str = "label_id") -> DataFrame:
    """Add the id of each label; NULL for a label not in the index."""
    lookup = index.select(F.col("label").alias("_label"), F.col("label_id").alias(alias))
    return df.join(lookup, F.col(label).cast("string") == F.col("_label"), "left").drop("_label")


def split_of(key: Column, held_out: float = 0.2, seed: int = 42) -> Column:
    """``"val"`` for a ``held_out`` share of the keys, else ``"train"``.

    A hash of seed and key decides, so a row keeps its side whatever the
    partitioning, and growth of the table moves no old row.
    """
    bound = format(round(held_out * 16**8), "08x") if held_out < 1 else "g"
    return F.when(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))) < bound, "val").otherwise("train")


def hash_split(df: DataFrame, key: str, held_out: float = 0.2, seed: int = 42) -> DataFrame:
    return df.withColumn("split", split_of(F.col(key), held_out, seed))


def class_shares(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows per split and label with the percentage within the split."""
    cells = df.groupBy(split, label).agg(n_rows().alias("n"))
    totals = cells.groupBy(split).agg(F.sum("n").alias("_all"))
    return cells.join(totals, split).select(split, label, "n", percent(F.col("n"), F.col("_all")).alias("pct"))


def standardize(vector: Column, mean: Sequence[float], std: Sequence[float], rescale: float = 1.0) -> Column:
    """``(x * rescale - mean) / std`` on an array laid out channel by channel.

    The array is cut into ``len(mean)`` equal channels; a single mean and
    deviation normalise the whole array.
    """
    per_channel = F.size(vector) / F.lit(len(mean))
    means, stds = F.array(*[F.lit(float(m)) for m in mean]), F.array(*[F.lit(float(s)) for s in std])

    def one(x: Column, i: Column) -> Column:
        channel = F.floor(i / per_channel).cast("int")
        return (x.cast("double") * rescale - F.get(means, channel)) / F.get(stds, channel)

    return F.transform(vector, one)


def prediction_table(df: DataFrame, image: str, label: str, score: str, levels=CONFIDENCE_LEVELS) -> DataFrame:
    """Predictions with their confidence level and whether that level is reliable."""
    level = banded(F.col(score), levels)
    return df.select(
        F.col(image).alias("image_name"),
        F.col(label).alias("damage_label"),
        F.col(score).alias("damage_score"),
        level.alias("confidence_level"),
        F.coalesce(level.isin(*RELIABLE_LEVELS), F.lit(False)).alias("is_reliable"),
    )


def accuracy(df: DataFrame, label: str, predicted: str, overall: str = "(all)") -> DataFrame:
    """Share of right predictions per true label and overall, as (label, n, accuracy).

    Rows are counted once, by label; the overall row adds up the counts.  Rows without a true label are left out.
    """
    hit = F.coalesce(F.col(label) == F.col(predicted), F.lit(False))
    judged = require(df, label).select(F.col(label).cast("string").alias("label"), hit.alias("hit"))
    by_label = judged.groupBy("label").agg(n_rows().alias("n"), F.count_if("hit").alias("hits"))
    every = by_label.rollup("label").agg(F.grouping("label").alias("_all"), F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    rate = stable_round(F.try_divide("hits", "n"), 4)
    name = F.when(F.col("_all") == 1, overall).otherwise(F.col("label"))
    return every.filter("n > 0").select(name.alias("label"), "n", rate.alias("accuracy"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows per (true label, predicted label)."""
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(n_rows().alias("n"))
