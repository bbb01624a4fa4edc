"""Label dictionaries, splits, vectors, predictions, accuracy, classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato.functions.numbers import stable_round
from estrato.operators import labels
from estrato.operators.aggregates import counts, imbalance, share
from estrato.operators.classifier import rank_classes
from estrato.plans import training
from estrato.workload.registry import Tables, pct, query, rounded


@query("count_by_label", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def count_by_label(t: Tables):
    return counts(t.embeddings, "label").orderBy("label")


_SHARE = "c AS (SELECT source, count(*) AS n FROM documents GROUP BY source)"
_PCT = pct("n", "(SELECT sum(n) FROM c)")


@query("label_distribution", f"WITH {_SHARE} SELECT source, n, {_PCT} AS pct FROM c")
def label_distribution(t: Tables):
    return share(t.documents, "source").orderBy("source")


@query(
    "label_imbalance",
    f"WITH {_SHARE}, p AS (SELECT {_PCT} AS pct FROM c) SELECT min(pct) AS min_pct, min(pct) < 5 AS imbalanced FROM p",
)
def label_imbalance(t: Tables):
    return imbalance(t.documents, "source")


@query(
    "label_index",
    "SELECT CAST(row_number() OVER (ORDER BY p_name) - 1 AS INTEGER) AS label_id, p_name AS label "
    "FROM (SELECT DISTINCT p_name FROM part)",
)
def label_index(t: Tables):
    return labels.label_index(t.part, "p_name")


@query(
    "encoded_labels",
    "SELECT p_partkey, p_name, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS label_id FROM part",
)
def encoded_labels(t: Tables):
    parts = t.part.select("p_partkey", "p_name")
    return labels.encode_labels(parts, "p_name", labels.label_index(parts, "p_name"))


_SIDE = "CASE WHEN md5('42|' || CAST(doc_id AS VARCHAR)) < '33333333' THEN 'val' ELSE 'train' END"


@query("train_val_split", f"SELECT doc_id, source, {_SIDE} AS split FROM documents")
def train_val_split(t: Tables):
    return labels.hash_split(t.documents.select("doc_id", "source"), "doc_id")


@query(
    "split_distribution",
    f"WITH c AS (SELECT {_SIDE} AS split, source, count(*) AS n FROM documents GROUP BY ALL) SELECT split, source, n, "
    f"{pct('n', 'sum(n) OVER (PARTITION BY split)')} AS pct FROM c",
)
def split_distribution(t: Tables):
    return labels.class_shares(labels.hash_split(t.documents.select("doc_id", "source"), "doc_id"), "source")


# Channel means and deviations used to normalise RGB images.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


@query(
    "standardize_vectors",
    "WITH x AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos, "
    "len(embedding) AS n FROM embeddings), c AS (SELECT *, CAST(floor(pos / (n / 3)) AS INTEGER) AS ch FROM x) "
    "SELECT vec_id, CAST(pos AS INTEGER) AS pos, "
    + rounded(
        "(CAST(v AS DOUBLE) - CASE ch WHEN 0 THEN 0.485::DOUBLE WHEN 1 THEN 0.456::DOUBLE ELSE 0.406::DOUBLE END) / "
        "CASE ch WHEN 0 THEN 0.229::DOUBLE WHEN 1 THEN 0.224::DOUBLE ELSE 0.225::DOUBLE END",
        6,
    )
    + " AS value FROM c",
)
def standardize_vectors(t: Tables):
    vectors = t.embeddings.select("vec_id", labels.standardize(F.col("embedding"), CHANNEL_MEAN, CHANNEL_STD).alias("v"))
    return vectors.select("vec_id", F.posexplode("v").alias("pos", "value")).withColumn(
        "value", stable_round(F.col("value"), 6)
    )


# Every vector is scored against the mean vector of each label; all its entries count.
_SCORED = (
    "means AS (SELECT label, pos, CAST(CAST(CAST(avg(x) AS VARCHAR) AS DECIMAL(38,6)) AS DOUBLE) AS m FROM (SELECT label, "
    "unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos), "
    "centres AS (SELECT label, list(m ORDER BY pos) AS centre FROM means GROUP BY label), "
    "near AS (SELECT vec_id, e.label AS truth, c.label AS guess, CAST(CAST(CAST(list_sum(list_transform("
    "range(1, len(embedding) + 1), lambda i: CAST(embedding[i] AS DOUBLE) * centre[i])) AS VARCHAR) AS DECIMAL(38,6)) AS DOUBLE) AS closeness "
    "FROM embeddings e CROSS JOIN centres c), "
    "best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY closeness DESC, guess) AS place FROM near), "
    "scored AS (SELECT 'img_' || CAST(vec_id AS VARCHAR) || '.jpg' AS image_name, CAST(truth AS VARCHAR) AS truth, "
    "CAST(guess AS VARCHAR) AS guess, least(greatest(closeness, 0.0::DOUBLE) * 3, 1.0::DOUBLE) AS score FROM best WHERE place = 1)"
)


def scored(t: Tables):
    """Stand-in scores: the label whose mean vector is closest by inner product, and how close it is."""
    entries = t.embeddings.select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "x"))
    # Entries have 24 bits, so the sums of doubles are exact here in any order.
    means = entries.groupBy("label", "pos").agg(stable_round(F.avg("x"), 6).alias("m"))
    centres = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m")))["m"].alias("centre"))
    # One row per label, as long as a vector: bounded by the classes, not by the rows.
    every = centres.agg(F.collect_list(F.struct("label", "centre"))).scalar()
    vector = F.col("embedding").cast("array<double>")

    def close(centre):
        return F.aggregate(F.zip_with(vector, centre, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)

    near = F.transform("every", lambda c: F.struct(stable_round(close(c["centre"]), 6).alias("closeness"), (-c["label"]).alias("neg")))
    best = t.embeddings.withColumn("every", every).select("vec_id", "label", F.array_max(near).alias("best"))
    return best.select(
        F.concat(F.lit("img_"), F.col("vec_id").cast("string"), F.lit(".jpg")).alias("image_name"),
        F.col("label").cast("string").alias("truth"),
        (-F.col("best.neg")).cast("string").alias("guess"),
        F.least(F.greatest(F.col("best.closeness"), F.lit(0.0)) * 3, F.lit(1.0)).alias("score"),
    )


@query(
    "confidence_bands",
    f"WITH {_SCORED} SELECT image_name, guess AS damage_label, {rounded('score', 6)} AS damage_score, "
    "CASE WHEN score >= 0.8 THEN 'alta' WHEN score >= 0.5 THEN 'media' ELSE 'baja' END AS confidence_level, "
    "score >= 0.5 AS is_reliable FROM scored",
)
def confidence_bands(t: Tables):
    out = labels.prediction_table(scored(t), "image_name", "guess", "score")
    return out.withColumn("damage_score", stable_round(F.col("damage_score"), 6))


_RATE = rounded("avg(CASE WHEN truth = guess THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", 4)


@query(
    "accuracy_by_class",
    f"WITH {_SCORED} SELECT truth AS label, count(*) AS n, {_RATE} AS accuracy FROM scored GROUP BY truth "
    f"UNION ALL SELECT '(all)', count(*), {_RATE} FROM scored",
)
def accuracy_by_class(t: Tables):
    return labels.accuracy(scored(t), "truth", "guess")


@query("confusion_matrix", f"WITH {_SCORED} SELECT truth AS label, guess AS predicted, count(*) AS n FROM scored GROUP BY ALL")
def confusion_matrix(t: Tables):
    return labels.confusion(scored(t), "truth", "guess")


@query(
    "topk_classes",
    "WITH s AS (SELECT vec_id, 'c' || lpad(CAST(generate_subscripts(embedding, 1) - 1 AS VARCHAR), 3, '0') AS label, "
    "CAST(unnest(embedding) AS DOUBLE) AS score FROM embeddings), r AS (SELECT *, "
    "row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS place FROM s) "
    f"SELECT vec_id, CAST(place - 1 AS INTEGER) AS pos, label, {rounded('score', 6)} AS score FROM r WHERE place <= 3",
)
def topk_classes(t: Tables):
    """Each entry of a vector is the score of a class named by its position."""
    scores = F.col("embedding").cast("array<double>")
    names = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.concat(F.lit("c"), F.lpad(i.cast("string"), 3, "0")))
    ranked = t.embeddings.select("vec_id", F.posexplode(rank_classes(scores, names, 3)).alias("pos", "class"))
    return ranked.select("vec_id", "pos", "class.label", stable_round(F.col("class.score"), 6).alias("score"))


# Vectors in which the class shows: the entries of the embedding, and one entry per class behind them.
_CLASSES = 10


def shown_vectors(t: Tables):
    shown = F.transform(F.sequence(F.lit(0), F.lit(_CLASSES - 1)), lambda c: F.when(c == F.col("label"), 4.0).otherwise(0.0))
    vector = F.concat(F.col("embedding").cast("array<double>"), shown)
    return t.embeddings.select(F.concat(F.lit("img_"), F.col("vec_id").cast("string")).alias("image_name"), "label", vector.alias("vector"))


@query(
    "classifier_predictions",
    "SELECT 'img_' || CAST(vec_id AS VARCHAR) AS image_name, CAST(label AS VARCHAR) AS damage_label, 'alta' AS confidence_level, "
    "TRUE AS is_reliable, TRUE AS score_fits FROM embeddings",
)
def classifier_predictions(t: Tables):
    """Predictions of a fitted model on vectors in which the class shows: it has to find it everywhere, and be sure."""
    predictions, _ = training.train_and_predict(shown_vectors(t), "image_name", "vector", "label")
    return predictions.select("image_name", "damage_label", "confidence_level", "is_reliable", F.col("damage_score").between(0.8, 1.0).alias("score_fits"))


@query(
    "classifier_hit_rate",
    "SELECT CAST(count(*) AS BIGINT) AS n, TRUE AS above_chance, TRUE AS finds_most_classes FROM embeddings "
    "WHERE md5('42|' || CAST(vec_id AS VARCHAR)) < '33333333'",
)
def classifier_hit_rate(t: Tables):
    """Which of its first five entries is a vector's largest: held out rows are hit twice as often as by chance at least."""
    first = F.transform(F.slice("embedding", 1, 5), lambda x: x.cast("double"))
    rows = t.embeddings.select("vec_id", "embedding", F.array_position(first, F.array_max(first)).alias("label"))
    _, found = training.train_and_predict(rows, "vec_id", "embedding", "label")
    every, single = F.col("label") == "(all)", F.col("label") != "(all)"
    row = found.agg(
        F.max(F.when(every, F.col("n"))).alias("n"),
        F.max(F.when(every, F.col("accuracy"))).alias("rate"),
        F.count_if(single).alias("classes"),
        F.count_if(single & (F.col("accuracy") > 0)).alias("found"),
    )
    return row.select("n", (F.col("rate") > 2 / F.col("classes")).alias("above_chance"), (F.col("found") > F.col("classes") / 2).alias("finds_most_classes"))
