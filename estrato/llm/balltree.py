"""Exact search for the highest integer inner products (operator 8, ball-tree branch and bound per shard).

Rows are dealt into shards; each shard builds a ball tree.  The inner product of a query with anything in a
ball is at most that with the centre plus the radius times the query's length; children are visited by that
bound, and a ball goes for the queries whose k-th score exceeds it.  All shards start from a shared k-th
score: the one among a bounded sample of rows, which the final one can only exceed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import meet, partitions
from estrato.llm.vectors import matrix, ranked, same_length, smallest_ids, usable

#: Rows of a leaf, of the sample that gives the first k-th scores, and of a shard.
LEAF, SAMPLE, SHARD = 64, 2048, 200_000
#: Below any score.
NONE = np.iinfo(np.int64).min


def quantised(rows: DataFrame, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, vector) with floor(scale * x) of every component, of the rows whose vectors are usable and whose id is not null."""
    values = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return rows.filter(usable(F.col(vector)) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("vector"))


def products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where all sums stay below 2**53."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, rows.shape[1])
    if most < 2**53:
        return (rows.astype(np.float64) @ queries.astype(np.float64).T).astype(np.int64)
    return rows @ queries.T


class _Tree:
    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.order = np.arange(len(ids))
        self.rows = rows.astype(np.float64)
        self.nodes: list[tuple[int, int, np.ndarray, float, int, int]] = []  # from, to, centre, radius, children
        if len(ids):
            self._grow(0, len(ids))
        self.ids, self.rows = ids[self.order], rows[self.order]

    def _grow(self, low: int, high: int) -> int:
        points = self.rows[self.order[low:high]]
        centre = points.mean(axis=0)
        away = np.linalg.norm(points - centre, axis=1)
        node = len(self.nodes)
        self.nodes.append((low, high, centre, float(away.max()), -1, -1))
        if high - low > LEAF and away.max() > 0:
            first = points[np.argmax(away)]
            second = points[np.argmax(np.linalg.norm(points - first, axis=1))]
            side = np.argsort(points @ (second - first), kind="stable")
            self.order[low:high] = self.order[low:high][side]
            middle = (low + high) // 2
            children = self._grow(low, middle), self._grow(middle, high)
            self.nodes[node] = (*self.nodes[node][:4], *children)
        return node


class _Search:
    """The best rows of one shard for a block of queries."""

    def __init__(self, tree: _Tree, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
        self.tree, self.query_ids, self.queries, self.k = tree, query_ids, queries, k
        self.real, self.size = queries.astype(np.float64), np.linalg.norm(queries.astype(np.float64), axis=1)
        self.scores = np.full((len(queries), k), NONE, np.int64)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)
        self.floors = floors.copy()
        if tree.nodes and len(queries):
            self._visit(0, np.arange(len(queries)))

    def _bound(self, node: int, active: np.ndarray) -> np.ndarray:
        _, _, centre, radius, _, _ = self.tree.nodes[node]
        return (self.real[active] @ centre + self.size[active] * radius) * (1 + 1e-12) + 0.5  # more than rounding takes

    def _visit(self, node: int, active: np.ndarray) -> None:
        low, high, _, _, left, right = self.tree.nodes[node]
        if left < 0:
            self._leaf(low, high, active)
            return
        bounds = {child: self._bound(child, active) for child in (left, right)}
        for child in sorted(bounds, key=lambda c: -bounds[c].sum()):
            rest = active[bounds[child] >= self.floors[active]]  # scores may have risen in the first child
            if len(rest):
                self._visit(child, rest)

    def _leaf(self, low: int, high: int, active: np.ndarray) -> None:
        found = products(self.tree.rows[low:high], self.queries[active]).T
        ids = np.broadcast_to(self.tree.ids[low:high], found.shape)
        found = np.where(ids == self.query_ids[active][:, None], NONE, found)
        better = (found >= self.floors[active][:, None]).any(axis=1)
        active, found, ids = active[better], found[better], ids[better]
        scores = np.concatenate([self.scores[active], found], axis=1)
        ids = np.concatenate([self.ids[active], ids], axis=1)
        order = np.argsort(ids, axis=1, kind="stable")
        scores, ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
        order = np.argsort(-(scores + 1), axis=1, kind="stable")[:, : self.k]
        self.scores[active], self.ids[active] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
        self.floors[active] = np.maximum(self.floors[active], self.scores[active, -1])


def _floors(queries: DataFrame, rows: DataFrame, dim: int, k: int) -> DataFrame:
    """``queries`` with the k-th score among a bounded sample of distinct ``rows``, at most the k-th score among all."""
    some = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    sample = rows.join(some, "vec_id", "left_semi").distinct().orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).toArrow()
    ids, values = sample.column("vec_id").to_numpy(), matrix(sample.column("vector"), dim)
    schema = queries.withColumn("floor", F.lit(0).cast("long")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("query_id").to_numpy()
            found = products(matrix(batch.column("vector"), dim), values)
            found[own[:, None] == ids[None, :]] = NONE
            kth = np.partition(found, -k, axis=1)[:, -k] if found.shape[1] >= k else np.full(len(own), NONE)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kth, pa.int64())], [*batch.schema.names, "floor"])

    return queries.mapInArrow(work, schema)


def search(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the highest integer inner products per query.

    ``rows`` has vec_id and vector (integers), ``queries`` query_id and vector.  Rows with the query's id are
    not candidates; ties go to the smaller vec_id; all candidates come back if there are fewer than ``k``.
    Shorter vectors count as filled up with zeros.  Repeated rows, of both tables, count as one; a candidate
    comes once with each of its scores.  An empty table gives no rows.
    """
    rows, dim = same_length(rows.select("vec_id", "vector").distinct(), "vector", 0)
    count = rows.count()
    if not count or not dim:
        return ranked(rows.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0).cast("long").alias("score")).filter("false"), k)
    queries = queries.select("query_id", F.concat(F.col("vector"), F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("vector"))).alias("vector")).distinct()
    shards = max(partitions(rows.sparkSession), -(-count // SHARD))
    dealt = rows.withColumn("place", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"))
    asked = _floors(queries, rows, dim, k).withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def build(items: pa.Table) -> _Tree:
        ids, values = items.column("vec_id").to_numpy(), matrix(items.column("vector"), dim)
        first = smallest_ids(ids, values, k + 1)
        return _Tree(ids[first], values[first])

    def answer(tree: _Tree, wanted: pa.RecordBatch) -> pa.RecordBatch:
        own = wanted.column("query_id").to_numpy()
        found = _Search(tree, own, matrix(wanted.column("vector"), dim), wanted.column("floor").to_numpy(), k)
        place, column = np.nonzero(found.scores > NONE)
        return pa.RecordBatch.from_arrays([pa.array(own[place]), pa.array(found.ids[place, column]), pa.array(found.scores[place, column])], ["query_id", "vec_id", "score"])

    return ranked(meet(dealt, asked, shards, build, answer, "query_id long, vec_id long, score long"), k)
