"""Registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.llm import balltree, coding, counting, fim, hardneg, kmeanstree, langid, linetemplates, neardup, oracles, packing, pii, quality, substring
from estrato.llm.common import importable

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query("op2_bpe_coding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coding.digests(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op3_substring_dedup", oracles.REPEATED_PASSAGES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_nearest_neighbours")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kmeanstree.vectors(table(spark, sf_dir, "embeddings"))
    asked = F.col("vec_id") % 20 == 0
    index = kmeanstree.build(rows, calibrate=asked)
    return kmeanstree.search(index, rows.filter(asked).withColumnRenamed("vec_id", "query_id"))


@query("op5_line_templates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linetemplates.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"), dropped="n_dropped")
    return found.select("doc_id", "n_dropped", F.length("text").cast("long").alias("n_chars_kept"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learnable = langid.learnable(F.col("doc_id"))
    found = langid.predict(docs, langid.fit(docs.filter(learnable)))
    return found.select("doc_id", F.coalesce(~learnable, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op7_near_duplicates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("represents"))


@query("op8_exact_topk", oracles.EXACT_TOPK)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = balltree.quantised(table(spark, sf_dir, "embeddings"))
    return balltree.search(rows, rows.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        F.coalesce(~quality.learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op11_hard_negatives", oracles.HARD_NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(hardneg.quantised(given.withColumn("label", label)), F.col("vec_id") % 50 == 0)


@query("op12_token_counts")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.token_counts(table(spark, sf_dir, "documents"), PIECES, keep=["doc_id"])


@query("op13_fill_in_middle", oracles.FILL_IN_MIDDLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"), keep=["doc_id"])
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)
