"""Labelled images: readiness, split, classifier, prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.functions.text import file_extension
from estrato.operators.aggregates import counts, n_rows
from estrato.operators.classifier import score_topk, train_classifier
from estrato.operators.labels import accuracy, hash_split, prediction_table
from estrato.operators.quality import gate

IMAGE_COLUMNS = ("path", "image_name", "label", "content")


def missing_columns(images: DataFrame, expected=IMAGE_COLUMNS) -> list[str]:
    present = {c.lower() for c in images.columns}
    return [c for c in expected if c.lower() not in present]


def _blank(column: str):
    return F.coalesce(F.col(column) == "", F.lit(True))


def readiness(images: DataFrame) -> DataFrame:
    """One row: image count, missing values per column, and the verdict."""
    blanks = [F.count_if(_blank(c)).alias(f"blank_{c}") for c in ("label", "path", "image_name")]
    if "content" in images.columns:
        blanks.append(F.count_if(F.col("content").isNull()).alias("null_content"))
    ready = (F.col("total") > 0) & (F.col("blank_label") + F.col("blank_path") + F.col("blank_image_name") == 0)
    return images.agg(n_rows().alias("total"), *blanks).withColumn("ready", ready)


def require_ready(images: DataFrame, expected=("path", "image_name", "label")) -> dict:
    """Raise ``ValueError`` for absent columns, an empty table or blank labels."""
    absent = missing_columns(images, expected)
    if absent:
        raise ValueError(f"columns are absent: {', '.join(absent)}")
    return gate(readiness(images), at_most={"blank_label": 0}, at_least={"total": 1})


def extension_counts(images: DataFrame) -> DataFrame:
    named = images.select(file_extension(F.col("image_name")).alias("extension"))
    return counts(named, "extension").orderBy("extension")


def predict_images(training: DataFrame, images: DataFrame, vectors: DataFrame) -> DataFrame:
    """Predictions for ``images`` by a classifier fitted on the labelled ``training`` images.

    ``vectors`` holds (image_name, vector) of both.  Training is refused if the labelled images are not
    ready; an image without a vector gets no prediction.
    """
    require_ready(training)
    features = vectors.select("image_name", "vector")
    model = train_classifier(training.select("image_name", "label").join(features, "image_name"), "vector", "label")
    scored = score_topk(model, images.select("image_name").distinct().join(features, "image_name"), "vector", k=1)
    return prediction_table(scored, "image_name", "predicted", "score")


def train_and_predict(
    images: DataFrame, key: str, features: str, label: str, held_out: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(predictions, accuracy on the held out rows) of a classifier fitted on the rest."""
    split = hash_split(images, key, held_out, seed)
    model = train_classifier(split.filter("split = 'train'"), features, label)
    scored = score_topk(model, split, features, k=1)
    held = scored.filter("split = 'val'")
    return prediction_table(scored, key, "predicted", "score"), accuracy(held, label, "predicted")
