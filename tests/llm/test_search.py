"""Vector searches against comparison with everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from estrato.llm import balltree, kmeanstree
from estrato.llm.common import importable
from estrato.llm.queries import QUERIES


@pytest.fixture
def vectors(spark):
    importable(spark)
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=8).astype(np.float32).tolist(), 0) for i in range(600)]
    rows += [(600 + i, rows[3][1], 0) for i in range(150)]  # many copies of one vector
    bad = [(2000, None, 0), (2020, [1.0] * 7 + [float("nan")], 0), (2040, [float("inf")] + [0.0] * 7, 0), (2060, [1.0] * 7 + [None], 0), (None, [1.0] * 8, 0)]
    zero = [(2100, [0.0] * 8, 0)]
    return spark.createDataFrame(rows + bad + zero, "vec_id long, embedding array<float>, leaf int").repartition(5), rows, zero


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_exact(vectors):
    df, rows, zero = vectors
    items = balltree.quantised(df)
    found = _found(balltree.search(items, items.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")))
    ids = np.array([r[0] for r in rows + zero])
    values = np.floor(1024 * np.array([r[1] for r in rows + zero], np.float32).astype(np.float64)).astype(np.int64)
    assert found == brute.top(ids, values, [i for i in ids if i % 100 == 0], 10, lambda a, q: a @ q)


def test_exact_with_large_numbers(spark):
    importable(spark)
    rows = [(i, [2.0**17 * (i + 1), -(2.0**16) * i]) for i in range(30)]
    items = balltree.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = _found(balltree.search(items, items.filter("vec_id = 0").withColumnRenamed("vec_id", "query_id"), 3))
    values = np.array([[int(1024 * x) for x in r[1]] for r in rows], dtype=object)
    want = sorted(((int(v @ values[0]), -i) for i, v in enumerate(values) if i), reverse=True)[:3]
    assert found[0] == [(-i, s) for s, i in want]


@pytest.mark.parametrize("size", [1, 5])
def test_all_candidates_if_few(spark, size):
    importable(spark)
    df = spark.createDataFrame([(100 * i, [float(i), 1.0]) for i in range(size)], "vec_id long, embedding array<double>")
    items = balltree.quantised(df)
    assert balltree.search(items, items.withColumnRenamed("vec_id", "query_id")).count() == size * (size - 1)
    rows = kmeanstree.vectors(df)
    index = kmeanstree.build(rows, F.lit(True))
    assert kmeanstree.search(index, rows.withColumnRenamed("vec_id", "query_id")).count() == size * (size - 1)


@pytest.mark.parametrize("size", [10, 30, 500])
def test_exact_with_every_row_twice(spark, size):
    importable(spark)
    draw = np.random.default_rng(size)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(size)]
    items = balltree.quantised(spark.createDataFrame(rows * 2, "vec_id long, embedding array<double>").repartition(5))
    asked = items.filter("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    values = np.floor(1024 * np.array([r[1] for r in rows])).astype(np.int64)
    want = brute.top(np.arange(size), values, range(0, size, 10), 10, lambda a, q: a @ q)
    assert _found(balltree.search(items, asked)) == want


def test_one_row_many_times_does_not_fill_the_sample(spark):
    importable(spark)
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(200, 4))
    first = spark.range(200).orderBy(F.xxhash64("id")).first().id
    rows = [(i, vectors[i].tolist()) for i in range(200)] + [(first, vectors[first].tolist())] * 3000
    items = balltree.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    asked = items.filter("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    values = np.floor(1024 * vectors).astype(np.int64)
    want = brute.top(np.arange(200), values, range(0, 200, 10), 10, lambda a, q: a @ q)
    assert _found(balltree.search(items, asked)) == want


def test_nearest(vectors):
    df, rows, _ = vectors
    items = kmeanstree.vectors(df)
    asked = F.col("vec_id") % 20 == 0
    index = kmeanstree.build(items, asked)
    found = _found(kmeanstree.search(index, items.filter(asked).withColumnRenamed("vec_id", "query_id")))
    ids, values = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(np.float64)
    want = brute.top(ids, values, [i for i in ids if i % 20 == 0], 20, lambda a, q: (a * q).sum(axis=1))
    assert set(found) == set(want) and all(len(f) == 20 for f in found.values())
    assert np.mean([len(set(found[q]) & set(want[q])) / 20 for q in want]) >= 0.9
    scores = {q: dict(zip(ids.tolist(), (values * values[list(ids).index(q)]).sum(axis=1))) for q in want}
    assert all(scores[q][i] == s for q in found for i, s in found[q])
    assert all(f == sorted(f, key=lambda x: (-x[1], x[0])) for f in found.values())


def test_recall_on_the_given_table(spark, given):
    importable(spark)
    items = kmeanstree.vectors(spark.read.parquet(f"{given('0.01')}/embeddings.parquet"))
    asked = F.col("vec_id") % 20 == 0
    found = _found(kmeanstree.search(kmeanstree.build(items, asked), items.filter(asked).withColumnRenamed("vec_id", "query_id")))
    table = items.toPandas()
    ids, values = table.vec_id.to_numpy(), np.stack(table.vector)
    want = brute.top(ids, values, [i for i in ids if i % 20 == 0], 20, lambda a, q: (a * q).sum(axis=1))
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_empty_tables(spark):
    importable(spark)
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    items, rows = balltree.quantised(df), kmeanstree.vectors(df)
    assert balltree.search(items, items.withColumnRenamed("vec_id", "query_id")).count() == 0
    assert kmeanstree.search(kmeanstree.build(rows, F.lit(True)), rows.withColumnRenamed("vec_id", "query_id")).count() == 0


@pytest.mark.parametrize("name", ["op4_nearest_neighbours", "op8_exact_topk", "op11_hard_negatives"])
def test_queries_answer_alike_on_a_doubled_table(spark, given, tmp_path, name):
    importable(spark)
    table = spark.read.parquet(f"{given('0.001')}/embeddings.parquet")
    table.unionByName(table).unionByName(table.limit(1)).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    single, double = (sorted(map(tuple, QUERIES[name](spark, folder).collect())) for folder in (given("0.001"), str(tmp_path)))
    assert single == double != []
