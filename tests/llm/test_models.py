"""Held-out accuracy of the language and quality models, and their edge cases."""

import numpy as np
from pyspark.sql import functions as F

from estrato.llm import langid, quality
from estrato.llm.common import importable
from estrato.llm.queries import QUERIES

EDGES = [(1, None), (2, ""), (3, "12 !"), (4, "x"), (4, "x"), (None, "der die das und"), (6, "the " * 40_000)]


def test_language_held_out(spark, given):
    found = QUERIES["op6_language_id"](spark, given("0.01"))
    truth = spark.read.parquet(f"{given('0.01')}/documents.parquet").select("doc_id", "lang")
    right, rows = found.filter("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert rows > 250 and right > 0.97
    assert found.count() == truth.count() and found.filter("score < 0 OR score > 1").count() == 0
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    assert found.filter(F.col("held_out") != (remainder == 1)).count() == 0


def test_phrases_are_longest_matches():
    model = langid.Model(("one", "two"), ("abracadabra", "hocus pocus"))
    automata = langid._Automata(model)
    text = "abrapocusx dabra"
    symbols = automata.of_code[np.array([ord(c) for c in text])]
    found = automata.phrases(symbols, np.array([0]), np.array([len(text)]))[:, 0].tolist()

    def plain(sample):
        count, at = 0, 0
        while at < len(text):
            end = at + 1
            while end < len(text) and text[at : end + 1] in sample:
                end += 1
            count, at = count + 1, end
        return count

    assert found == [plain(s) for s in model.samples]


def test_language_edges(docs, spark, given):
    model = langid.fit(spark.read.parquet(f"{given('0.001')}/documents.parquet"))
    found = langid.predict(docs(EDGES), model).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(EDGES)
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by_id[1].score == 0
    assert by_id[4].lang_pred in model.languages and by_id[None].lang_pred == "de" and by_id[6].lang_pred == "en"
    nothing = langid.fit(docs([]).selectExpr("text", "CAST(NULL AS STRING) AS lang"))
    assert {r.lang_pred for r in langid.predict(docs(EDGES), nothing).collect()} == {"und"}
    assert langid.predict(docs([]), model).count() == 0


def test_copies_do_not_fill_the_sample(spark):
    importable(spark)
    rows = [(f"text {chr(97 + i % 26)}{chr(97 + i // 26)} of its own", "xx") for i in range(100)]
    table = spark.createDataFrame(rows, "text string, lang string")
    first = table.orderBy(F.xxhash64("text")).first()
    copies = spark.range(500).select(F.lit(first.text).alias("text"), F.lit("xx").alias("lang"))
    assert langid.fit(table.union(copies)) == langid.fit(table)


def test_quality_held_out(spark, given):
    found = QUERIES["op10_quality"](spark, given("0.01"))
    labels = spark.read.parquet(f"{given('0.01')}/labels.parquet")
    rows = found.filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    good, bad = rows[rows.quality == 1], rows[rows.quality == 0]
    assert len(bad) > 5 and (good.score.to_numpy()[:, None] > bad.score.to_numpy()).mean() > 0.95
    assert (rows.predicted == (rows.score >= 0.3)).all() and rows.score.between(0, 1).all()
    assert (rows.predicted == rows.quality).mean() > 0.95


def test_features_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = ["a b c\nd e f", None, "", "X! Y! 12\n\nX! Y! 12", "é" * 50, "\n", "one"]
    together = quality.features(pa.array(texts))
    alone = np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone) and together.shape == (7, len(quality.FEATURES))
    names = list(quality.FEATURES)
    assert together[0, names.index("lines")] == 1 / 6 and together[3, names.index("distinct_lines")] == 0.5


def test_pairs_learn_an_interaction():
    draw = np.random.default_rng(0)
    rows = draw.random((4000, 4))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.train(rows, labels)
    assert ((model.score(rows) > 0.5) == labels).mean() > 0.9


def test_quality_edges(docs, spark):
    importable(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    train = docs([(i, ("good words here. " if i % 2 else "## !! || ") * 20) for i in range(40)])
    model = quality.fit(train, labels)
    found = quality.score(docs(EDGES), model).collect()
    assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
    kept = quality.keep(train, model)
    assert kept.columns == train.columns and {r.doc_id for r in kept.collect()} == set(range(1, 40, 2))
    nothing = quality.fit(docs([]), labels.limit(0))
    assert {r.score for r in quality.score(docs(EDGES), nothing).collect()} == {0.5}
    assert quality.score(docs([]), model).count() == 0
