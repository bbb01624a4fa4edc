"""Label dictionaries, splits, vectors, accuracy, classifier, image headers."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from estrato.operators import labels
from estrato.operators.classifier import score_topk, train_classifier
from estrato.operators.images import header_of, image_headers, image_vectors, pillow_decoder
from estrato.plans import training


def test_label_index_counts_in_label_order(spark):
    names = ["dent", "d", "", "zeta", "den", "Ärger", "scratch", "dent", None, "dents", "a", "😀x", "😀"]
    df = spark.createDataFrame([(n,) for n in names], "l string")
    out = {r.label: r.label_id for r in labels.label_index(df, "l").collect()}
    expected = sorted({n for n in names if n is not None}, key=lambda n: n.encode())
    assert out == {n: i for i, n in enumerate(expected)}
    coded = labels.encode_labels(df, "l", labels.label_index(df, "l"))
    assert {r.l: r.label_id for r in coded.collect()} == {**out, None: None}


def test_split_is_stable_and_of_the_right_size(spark, rows):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    split = labels.hash_split(df, "k")
    assert rows(split) == rows(labels.hash_split(df.repartition(13), "k"))
    assert abs(split.filter("split = 'val'").count() / 20_000 - 0.2) < 0.01
    assert labels.hash_split(df, "k", seed=1).join(split, ["k", "split"]).count() < 20_000
    assert labels.hash_split(df, "k", held_out=1.0).filter("split = 'train'").count() == 0
    assert labels.hash_split(df, "k", held_out=0.0).filter("split = 'val'").count() == 0
    shares = labels.class_shares(split.withColumn("l", F.col("k") % 3), "l")
    sums = shares.groupBy("split").agg(F.sum("pct")).collect()
    assert all(abs(r[1] - 100) < 0.05 for r in sums)


def test_standardize_by_channel(spark):
    df = spark.createDataFrame([([0, 255, 51, 102, 0, 255],)], "v array<int>")
    out = df.select(labels.standardize(F.col("v"), (0.5, 0.2, 0.0), (0.5, 0.1, 1.0), rescale=1 / 255)).first()[0]
    assert out == pytest.approx([-1.0, 1.0, 0.0, 2.0, 0.0, 1.0])
    single = df.select(labels.standardize(F.col("v"), (255.0,), (255.0,))).first()[0]
    assert single == pytest.approx([-1.0, 0.0, -0.8, -0.6, -1.0, 0.0])


def test_accuracy(spark, rows):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), ("b", "b"), (None, "b")], "t string, p string")
    assert rows(labels.accuracy(df, "t", "p")) == [("(all)", 4, 0.5), ("a", 3, 0.3333), ("b", 1, 1.0)]
    assert rows(labels.accuracy(df.filter("false"), "t", "p")) == []
    assert ("a", "b", 1) in rows(labels.confusion(df, "t", "p"))


def test_prediction_bands(spark, rows):
    df = spark.createDataFrame([("x", "dent", 0.8), ("y", "dent", 0.5), ("z", "dent", 0.49), ("n", None, None)], "i string, l string, s double")
    assert rows(labels.prediction_table(df, "i", "l", "s"), "image_name", "confidence_level", "is_reliable") == [
        ("n", None, False), ("x", "alta", True), ("y", "media", True), ("z", "baja", False),
    ]


def test_classifier(spark):
    df = spark.range(300).select(
        "id",
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("label"),
        F.array(*[((F.col("id") % 3 == i).cast("double") + F.sin(F.col("id")) / 10) for i in range(3)]).alias("v"),
    )
    model = train_classifier(df, "v", "label")
    scored = score_topk(model, df, "v", k=2)
    row = scored.first()
    assert len(row.ranked) == 2 and row.ranked[0].score >= row.ranked[1].score
    assert row.predicted == row.ranked[0].label and row.score == row.ranked[0].score
    assert scored.filter("label <> predicted").count() == 0
    assert abs(sum(p.score for p in score_topk(model, df, "v").first().ranked) - 1) < 1e-9
    predictions, accuracy = training.train_and_predict(df, "id", "v", "label")
    assert predictions.count() == 300 and accuracy.filter("label = '(all)'").first().accuracy == 1.0


PNG = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 640, 480) + b"\x08\x02\0\0\0"
JPEG = b"\xff\xd8" + b"\xff\xe0\x00\x04ab" + b"\xff\xc4\x00\x03x" + b"\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 100, 200) + b"\x01\x01\x11\x00"


def test_image_headers(spark):
    assert header_of(JPEG[:8]) == ("jpeg", None, None)
    df = spark.createDataFrame(
        [("a", bytearray(PNG)), ("b", bytearray(JPEG)), ("c", bytearray(b"GIF")), ("d", None), ("e", bytearray(b""))],
        "path string, content binary",
    )
    out = image_headers(df)
    assert out.columns == ["path", "format", "width", "height"]
    assert sorted(map(tuple, out.collect())) == [
        ("a", "png", 640, 480), ("b", "jpeg", 200, 100), ("c", None, None, None), ("d", None, None, None), ("e", None, None, None),
    ]


def test_image_vectors_are_channel_by_channel(spark):
    def decoder(content):
        return np.frombuffer(content, dtype="uint8").reshape(1, 2, 3)

    df = spark.createDataFrame([("a", bytearray([1, 2, 3, 4, 5, 6])), ("n", None)], "path string, content binary")
    out = image_vectors(df, decoder)
    assert out.columns == ["path", "pixels"]
    assert {r.path: r.pixels for r in out.collect()} == {"a": [1.0, 4.0, 2.0, 5.0, 3.0, 6.0], "n": None}
    scaled = out.filter("path = 'a'").select(labels.standardize(F.col("pixels"), (1, 2, 3), (1, 1, 1))).first()[0]
    assert scaled == [0.0, 3.0, 0.0, 3.0, 0.0, 3.0]


def test_pillow_decoder():
    pytest.importorskip("PIL")
    import io

    from PIL import Image

    buffer = io.BytesIO()
    Image.new("L", (7, 5), 128).save(buffer, "PNG")
    assert pillow_decoder(4)(buffer.getvalue()).shape == (4, 4, 3)


def test_labels_with_one_prefix_are_dealt_out(spark):
    """Ids follow the label order although all labels start alike, and no task gets more than its share."""
    names = [f"img_2024_{i:05}" for i in range(4000)]
    df = spark.createDataFrame([(n,) for n in names for _ in range(2)], "l string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = labels.label_index(df, "l")
        assert {r.label: r.label_id for r in out.collect()} == {n: i for i, n in enumerate(names)}
        ranged = labels.require(df, "l").distinct().repartitionByRange("l")
        assert max(r[1] for r in ranged.groupBy(F.spark_partition_id()).count().collect()) < 1500
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
