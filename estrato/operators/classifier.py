"""Training and distributed scoring of a classifier on feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def train_classifier(df: DataFrame, features: str, label: str, iterations: int = 20) -> PipelineModel:
    """Fit a multinomial regression on an array column; ids follow label order."""
    data = df.select(
        array_to_vector(F.col(features).cast("array<double>")).alias("features"),
        F.col(label).cast("string").alias("label"),
    )
    index = StringIndexer(inputCol="label", outputCol="label_id", stringOrderType="alphabetAsc")
    model = LogisticRegression(
        featuresCol="features", labelCol="label_id", maxIter=iterations, family="multinomial", regParam=0.01
    )
    fitted = Pipeline(stages=[index, model]).fit(data)
    # The training summary holds the session and the data; tasks that score would have to take them along.
    fitted.stages[-1]._java_obj.setSummary(df.sparkSession._jvm.scala.Option.empty())
    return fitted


def rank_classes(scores: Column, labels: Sequence[str] | Column, k: int | None = None) -> Column:
    """Classes by falling score as an array of (label, score); equal scores by label.

    ``scores[i]`` belongs to ``labels[i]``.  Sorting happens inside the row.
    """
    names = labels if isinstance(labels, Column) else F.array(*[F.lit(x) for x in labels])
    pairs = F.transform(
        F.arrays_zip(scores.alias("score"), names.alias("label")),
        lambda p: F.struct((-p["score"]).alias("neg"), p["label"].alias("label")),
    )
    ranked = F.transform(
        F.array_sort(pairs), lambda p: F.struct(p["label"].alias("label"), (-p["neg"]).alias("score"))
    )
    return ranked if k is None else F.slice(ranked, 1, k)


def score_topk(model: PipelineModel, df: DataFrame, features: str, k: int | None = None) -> DataFrame:
    """Add the classes by falling score (``ranked``), the best one and its score.

    Scoring is a projection on the executors.
    """
    index, classifier = model.stages
    data = df.withColumn("features", array_to_vector(F.col(features).cast("array<double>")))
    ranked = rank_classes(vector_to_array("probability"), index.labels, k)
    return classifier.transform(data).select(*df.columns, ranked.alias("ranked")).withColumns(
        {"predicted": F.col("ranked")[0]["label"], "score": F.col("ranked")[0]["score"]}
    )
