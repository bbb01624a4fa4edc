"""Hard negatives of anchor vectors (operator 11, BOND vertical scan).

Rows are dealt once into shards, which hold their vectors as columns, one per dimension.  Anchors travel to the
shards as a stream.  For each of them the columns are read in descending order of the anchor's magnitudes; what the
columns still to be read can add to a score lies between bounds that the smallest and largest value of each column
give, so every candidate has a lowest and a highest possible score.  A bitmap keeps the candidates that can still
count, and shrinks until the scores of those left are exact.

The scan runs twice: first over rows of the anchor's label, for its positives; then over rows of other labels, for
the best negatives inside the window of scores that each positive opens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import meet, partitions, saved
from estrato.llm.vectors import matrix, usable

#: Bytes of the columns of a shard, columns read between two looks at the bitmap, and candidates that are read to the end.
SHARD_BYTES, COLUMNS, FEW = 64 << 20, 8, 32


def quantised(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) with floor(scale * x) of every component, of the rows that take part.

    Those with a null id, a null label, a null vector, or a null or non-finite component do not.
    """
    values = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    there = usable(F.col(vector)) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    return rows.filter(there).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), values.alias("vector"))


class _Windows(NamedTuple):
    """Scores that count: the ``count`` highest from ``low`` to ``high``, for each of some windows."""

    low: np.ndarray
    high: np.ndarray
    count: int

    def keep(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which candidates, whose scores lie between ``least`` and ``most``, can still be among those of a window."""
        out = np.zeros(len(least), bool)
        for low, high in zip(self.low, self.high):
            inside = least[most <= high]
            if len(inside) >= self.count:  # so many have at least this score and do not exceed the window
                low = max(low, np.partition(inside, len(inside) - self.count)[len(inside) - self.count])
            out |= (most >= low) & (least <= high)
        return out


class _Shard:
    """Rows as columns, ordered by label and id, with the bounds of each column per label and of all."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, kind: type):
        order = np.lexsort((ids, labels))
        self.ids, labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T).astype(kind)
        self.labels, heads = np.unique(labels, return_index=True)
        self.edges = np.append(heads, len(ids))
        self.low, self.high = (f.reduceat(self.columns, heads, axis=1) for f in (np.minimum, np.maximum))

    def rows_of(self, label: int) -> tuple[int, int, int]:
        """Where the rows of a label are: their number among labels (-1 for none), from, to."""
        at = int(np.searchsorted(self.labels, label))
        if at == len(self.labels) or self.labels[at] != label:
            return -1, 0, 0
        return at, int(self.edges[at]), int(self.edges[at + 1])

    def scan(self, anchor: np.ndarray, candidates: np.ndarray, groups: np.ndarray, keep: Callable) -> tuple[np.ndarray, np.ndarray]:
        """The candidates that ``keep`` leaves, and their exact scores; ``groups`` are the labels they can have."""
        if not len(candidates):
            return candidates, np.zeros(0, self.columns.dtype)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = anchor[order, None] * self.low[np.ix_(order, groups)], anchor[order, None] * self.high[np.ix_(order, groups)]
        # What the columns from each on can add, at least and at most.
        least = np.append(np.cumsum(np.minimum(*ends).min(axis=1)[::-1])[::-1], 0)
        most = np.append(np.cumsum(np.maximum(*ends).max(axis=1)[::-1])[::-1], 0)
        scores, read = np.zeros(len(candidates), self.columns.dtype), 0
        while read < len(order):
            some = order[read:] if len(candidates) <= FEW else order[read : read + COLUMNS]
            if len(candidates) == candidates[-1] - candidates[0] + 1:
                found = self.columns[some, candidates[0] : candidates[-1] + 1]
            else:
                found = self.columns[np.ix_(some, candidates)]
            scores += anchor[some] @ found
            read += len(some)
            left = keep(scores + least[read], scores + most[read])
            if not left.all():
                candidates, scores = candidates[left], scores[left]
            if not len(candidates):
                break
        return candidates, scores

    def nearest(self, own: int, label: int, anchor: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of at least the ``count`` best rows of the label other than the anchor's own."""
        group, start, end = self.rows_of(label)
        candidates = np.arange(start, end)
        candidates = candidates[self.ids[candidates] != own]

        def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            if len(least) <= count:
                return np.ones(len(least), bool)
            return most >= np.partition(least, len(least) - count)[len(least) - count]

        places, scores = self.scan(anchor, candidates, np.array([group]), keep)
        return self._best(places, scores, count)

    def inside(self, own: int, label: int, anchor: np.ndarray, windows: _Windows) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per window its number, and ids and scores of its best rows of other labels."""
        group, start, end = self.rows_of(label)
        candidates = np.concatenate([np.arange(start), np.arange(end, len(self.ids))])
        candidates = candidates[self.ids[candidates] != own]
        groups = np.delete(np.arange(len(self.labels)), group) if group >= 0 else np.arange(len(self.labels))
        places, scores = self.scan(anchor, candidates, groups, windows.keep)
        for number, (low, high) in enumerate(zip(windows.low, windows.high)):
            within = (scores >= low) & (scores <= high)
            yield number, *self._best(places[within], scores[within], windows.count)

    def _best(self, places: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[places], -scores))[:count]
        return self.ids[places[order]], scores[order].astype(np.int64)


def _floor(value: int, part: int) -> int:
    return value * part // 100


def mine(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives from ``rows``.

    ``rows`` has vec_id, label and vector (integers), as ``quantised`` gives them; ``anchors`` is a condition on
    them.  Scores are integer inner products with the anchor, higher first, ties by smaller vec_id.  An anchor's
    positives are its first ``positives`` other rows of its label; for each of them come the first ``negatives`` rows
    of other labels whose score is from ``low`` to ``high`` percent of the positive's (none, if that is negative).

    All rows that are there count if they are fewer.  Repeated rows (id, label and vector) count as one; different
    rows of one id are rows of their own, but never partners of each other.  Shorter vectors count as filled up
    with zeros.  An empty table, and an anchor without positives or negatives, give no rows.  Vectors so long that a
    score might not fit into 64 bits raise ``ValueError``.
    """
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", "vector")
    size = F.array_max(F.transform("vector", F.abs))
    count, dim, most = rows.agg(F.count("*"), F.max(F.size("vector")), F.max(size)).first()
    dim, most = dim or 0, most or 0
    # The narrowest numbers that hold all components, and all sums of products exactly.
    stored = "short" if most < 1 << 15 else "int" if most < 1 << 31 else "long"
    total = most * most * max(1, dim)
    kind = np.float32 if total < 1 << 24 else np.float64 if total < 1 << 53 else np.int64
    if total >= 1 << 63:
        raise ValueError("inner products of these vectors may not fit into 64 bits")
    shards = max(partitions(spark), -(-count * max(1, dim) * np.dtype(kind).itemsize // SHARD_BYTES))
    filled = F.concat(F.col("vector"), F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("vector")))
    rows = rows.withColumn("vector", filled.cast(f"array<{stored}>")).distinct()

    dealt = rows.withColumn("place", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    # Different rows of one id are different anchors.
    asked = saved(rows.filter(anchors).withColumn("anchor", F.xxhash64("label", "vector")))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("place")

    def build(items: pa.Table) -> _Shard:
        return _Shard(items.column("vec_id").to_numpy(), items.column("label").to_numpy(), matrix(items.column("vector"), dim), kind)

    def nearest(shard: _Shard, part: pa.RecordBatch) -> pa.RecordBatch:
        own, labels, vectors = part.column("vec_id"), part.column("label").to_pylist(), matrix(part.column("vector"), dim).astype(kind)
        found = [shard.nearest(i, l, v, positives) for i, l, v in zip(own.to_pylist(), labels, vectors)]
        at = pa.array(np.repeat(np.arange(len(found)), [len(ids) for ids, _ in found]))
        ids, scores = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([own.take(at), part.column("anchor").take(at), pa.array(ids), pa.array(scores)], ["anchor_id", "anchor", "positive_id", "positive_score"])

    key = ["anchor_id", "anchor"]
    near = meet(dealt, asked.select("*", everywhere), shards, build, nearest, "anchor_id long, anchor long, positive_id long, positive_score long")
    number = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("positive_score"), "positive_id"))
    first = saved(near.withColumn("number", number - 1).filter(F.col("number") < positives))

    scores = first.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("number", "positive_score"))).alias("scores"))
    opened = asked.withColumnRenamed("vec_id", "anchor_id").join(scores, key)
    opened = opened.select(F.col("anchor_id").alias("vec_id"), "anchor", "label", "vector", F.col("scores.positive_score").alias("scores"), everywhere)

    def inside(shard: _Shard, part: pa.RecordBatch) -> pa.RecordBatch:
        own, labels, vectors = part.column("vec_id"), part.column("label").to_pylist(), matrix(part.column("vector"), dim).astype(kind)
        at, numbers, ids, found = [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, (row, label, vector, open_) in enumerate(zip(own.to_pylist(), labels, vectors, part.column("scores").to_pylist())):
            windows = _Windows(np.array([-_floor(-s, low) for s in open_]), np.array([_floor(s, high) for s in open_]), negatives)
            for number, some, score in shard.inside(row, label, vector, windows):
                at += [i] * len(some)
                numbers += [number] * len(some)
                ids.append(some)
                found.append(score)
        at = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays([own.take(at), part.column("anchor").take(at), pa.array(numbers, pa.int32()), pa.array(np.concatenate(ids)), pa.array(np.concatenate(found))], ["anchor_id", "anchor", "number", "negative_id", "negative_score"])

    hard = meet(dealt, opened, shards, build, inside, "anchor_id long, anchor long, number int, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy(*key, "number").orderBy(F.desc("negative_score"), "negative_id"))
    best = hard.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return best.join(first, [*key, "number"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
