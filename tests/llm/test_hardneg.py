"""Hard negatives against comparison with everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from estrato.llm import hardneg
from estrato.llm.common import importable

SCHEMA = "vec_id long, embedding array<double>, label long"


def _brute(rows, anchors, positives=5, negatives=3):
    """Every anchor with every row; ``rows`` are (id, integer vector, label)."""
    out = []
    for a, v, label in [r for r in rows if anchors(r[0])]:
        scored = [(-sum(x * y for x, y in zip(v, w)), b, other) for b, w, other in rows if b != a]
        near = sorted((s, b) for s, b, other in scored if other == label)[:positives]
        for s, p in near:
            hard = sorted((t, b) for t, b, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s)[:negatives]
            out += [(a, p, i + 1, b, -s, -t) for i, (t, b) in enumerate(hard)]
    return sorted(out)


def _found(spark, rows, every=5, shards=5):
    importable(spark)
    items = hardneg.quantised(spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).repartition(shards))
    return sorted(map(tuple, hardneg.mine(items, F.col("vec_id") % every == 0).collect()))


def _whole(rows):
    return [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("size,dim", [(400, 20), (60, 3)])
def test_random_vectors(spark, size, dim):
    draw = np.random.default_rng(size)
    rows = [(i, (draw.normal(size=dim) + 0.4).tolist(), int(draw.integers(4))) for i in range(size)]
    assert _found(spark, rows) == _brute(_whole(rows), lambda i: i % 5 == 0) != []


def test_copies_ties_and_rows_that_take_no_part(spark):
    draw = np.random.default_rng(1)
    rows = [(i, (draw.integers(-3, 9, size=4) / 4).tolist(), i % 3) for i in range(120)]
    rows += [(200 + i, rows[10][1], i % 2) for i in range(80)]  # one vector under many ids and two labels
    bad = [(300, None, 1), (305, [1.0, float("nan"), 0.0, 0.0], 1), (310, [float("inf")] + [0.0] * 3, 1), (315, [1.0, None, 0.0, 0.0], 1), (320, [1.0] * 4, None), (None, [1.0] * 4, 1)]
    want = _brute(_whole(rows), lambda i: i % 5 == 0)
    assert _found(spark, rows + bad) == want != []
    assert _found(spark, rows * 2 + bad + [rows[0]] * 500) == want


def test_large_numbers_are_exact(spark):
    draw = np.random.default_rng(2)
    for scale in (1 << 12, 1 << 19):
        rows = [(i, (draw.integers(1, 1000, size=6) * float(scale) / 256).tolist(), i % 2) for i in range(60)]
        assert _found(spark, rows) == _brute(_whole(rows), lambda i: i % 5 == 0) != []
    with pytest.raises(ValueError):
        _found(spark, [(0, [2.0**25], 0), (1, [1.0], 1)])


def test_few_rows(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(0, [1.0], 0)]) == []
    assert _found(spark, [(0, [1.0], 0), (1, [1.0], 0), (2, [0.75], 1)]) == [(0, 1, 1, 2, 65536, 49152)]
    # Negative positives open no window; a score of 0 opens one that only 0 is in.
    assert _found(spark, [(0, [1.0], 0), (1, [-1.0], 0), (2, [-0.75], 1)]) == []
    assert _found(spark, [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 3.0], 1)]) == [(0, 1, 1, 2, 0, 0)]
    # A shorter vector counts as filled up with zeros.
    assert _found(spark, [(0, [1.0, 1.0], 0), (1, [1.0], 0), (2, [0.5], 1)]) == [(0, 1, 1, 2, 65536, 32768)]


def test_rows_of_one_id_are_no_partners(spark):
    rows = [(0, [1.0], 0), (0, [0.75], 1), (1, [1.0], 0), (2, [0.9], 1)]
    found = _found(spark, rows)
    # Both rows of id 0 are anchors; neither sees the other.
    assert {(r[1], r[3]) for r in found} == {(1, 2)} and all(r[0] == 0 for r in found)


def test_bitmap_shrinks_before_all_columns_are_read():
    draw = np.random.default_rng(3)
    vectors = (draw.normal(size=(5000, 64)) * 2.0 ** -np.arange(64) * 1000).astype(np.int64)
    shard = hardneg._Shard(np.arange(5000), np.zeros(5000, np.int64), vectors, np.float64)
    read = []

    def keep(least, most):
        read.append(len(least))
        return most >= np.partition(least, len(least) - 5)[len(least) - 5]

    shard.scan(vectors[0].astype(np.float64), np.arange(1, 5000), np.array([0]), keep)
    assert read[0] == 4999 and read[1] < 500
