"""Corpus pipeline: raw documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.  All but the last
return the columns of documents; a stage that changes a text sets its n_chars anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.llm import linetemplates, neardup, packing, pii, quality
from estrato.llm.common import written
from estrato.llm.queries import TOKENIZER, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of these documents, does not reject."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go, except where they come first."""
    kept = linetemplates.drop_recurring(docs, dropped="__dropped")
    size = F.when(F.col("__dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return neardup.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    clean = pii.redact(docs.withColumn("__before", F.col("text")))
    size = F.when(F.col("text") != F.col("__before"), F.length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_recurring_lines),
    ("MinHash near-dedup", one_of_each_class),
    ("PII", without_personal_data),
    ("packing", packed),
]

#: None: SQL can express neither the classifier nor the signatures nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
