"""Approximate nearest neighbours (operator 4): hierarchical k-means tree with best-bin-first search.

The tree is learned from a bounded sample; every row then goes down it to one leaf.  A query takes the nodes
from a priority queue, the largest inner product with a centre first, until it has visited as many leaves as
reach the wanted recall.  That number is calibrated: for some queries the true neighbours are found by
comparing with every row, and visits are widened until enough of their leaves are among those visited.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import meet, saved
from estrato.llm.vectors import best, matrix, ranked, same_length, smallest_ids, usable

#: Rows of the sample, children of a node, rows of the sample in a leaf, and rounds of k-means.
SAMPLE, BRANCH, LEAF, ROUNDS = 16_384, 16, 64, 8
#: Queries that calibrate and the recall that they have to reach; rows, and queries, that a group of leaves holds.
CALIBRATE, RECALL, ROWS = 256, 0.97, 8192


@dataclass
class Tree:
    centres: list[np.ndarray] = field(default_factory=list)  # of the children of each inner node
    children: list[list[int]] = field(default_factory=list)  # inner node >= 0, leaf -1 - number
    leaves: int = 0

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: at every node the nearest centre."""
        out = np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, places = todo.pop()
            if not len(places):
                continue
            nearest = _nearest(rows[places], self.centres[node])
            for i, child in enumerate(self.children[node]):
                mine = places[nearest == i]
                if child < 0:
                    out[mine] = -1 - child
                else:
                    todo.append((child, mine))
        return out

    def visit(self, query: np.ndarray, leaves: int, held: np.ndarray, rows: int) -> list[int]:
        """Leaves in best-bin-first order: at least ``leaves`` with rows, and more until they hold ``rows`` rows."""
        out, total = [], 0
        queue = [(-np.inf, 0)]
        while queue and (len(out) < leaves or total < rows):
            _, node = heapq.heappop(queue)
            if node < 0:
                if held[-1 - node]:
                    out.append(-1 - node)
                    total += held[-1 - node]
                continue
            for score, child in zip((self.centres[node] @ query).tolist(), self.children[node]):
                heapq.heappush(queue, (-score, child))
        return out


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * rows @ centres.T, axis=1)


def grow(sample: np.ndarray, seed: int = 0) -> Tree:
    """Hierarchical k-means of a sample."""
    tree, draw = Tree(), np.random.default_rng(seed)

    def node(rows: np.ndarray) -> int:
        number = len(tree.centres)
        tree.centres.append(rows[:1])
        tree.children.append([])
        distinct = np.unique(rows, axis=0)
        centres = distinct[draw.permutation(len(distinct))[: min(BRANCH, max(2, -(-len(rows) // LEAF)))]]
        for _ in range(ROUNDS):
            near = _nearest(rows, centres)
            centres = np.stack([rows[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centres)])
        near = _nearest(rows, centres)
        tree.centres[number] = centres
        for i in range(len(centres)):
            part = rows[near == i]
            if len(part) > LEAF and len(part) < len(rows):
                tree.children[number].append(node(part))
            else:
                tree.leaves += 1
                tree.children[number].append(-tree.leaves)
        return number

    if len(sample):
        node(sample)
    return tree


def vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) as doubles, of the rows with an id and a usable vector other than zero."""
    there = usable(F.col(vector)) & F.exists(F.col(vector), lambda x: x != 0) & F.col("vec_id").isNotNull()
    return rows.filter(there).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))


def _score(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products whose rounding does not depend on what else is in the matrix."""
    return (rows * query).sum(axis=1)


def _local(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, seen: np.ndarray | None = None) -> tuple:
    """Of the rows that each query sees, its ``k`` best: query ids, places and scores, end to end."""
    first = smallest_ids(ids, rows, k + 1)
    ids, rows = ids[first], rows[first]
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for at in range(0, len(queries), 256):
        rough = rows @ queries[at : at + 256].T
        if seen is not None:
            rough[~seen[at : at + 256][:, first].T] = -np.inf
        for j in range(rough.shape[1]):
            column = np.where(ids == query_ids[at + j], -np.inf, rough[:, j])
            near = np.flatnonzero(column > -np.inf)
            if len(near) > k:
                limit = np.partition(column, len(column) - k)[len(column) - k]
                near = np.flatnonzero(column >= limit - 1e-9 * (1 + abs(limit)))
            score = _score(rows[near], queries[at + j])
            chosen = best(ids[near], score, k)
            out.append((np.full(len(chosen), query_ids[at + j]), first[near[chosen]], score[chosen]))
    return tuple(np.concatenate(x) for x in zip(*out))


def true_neighbours(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(query_id, leaf) of the true neighbours of a bounded number of queries, by comparing them with every row."""
    dim = queries.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
            own, places, score = _local(ids, matrix(batch.column("vector"), dim), query_ids, queries, k)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(ids[places]), pa.array(score), pa.array(leaf[places])], ["query_id", "vec_id", "score", "leaf"])

    found = rows.mapInArrow(work, "query_id long, vec_id long, score double, leaf int")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "leaf")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("query_id", "leaf")


@dataclass
class Index:
    """A tree, all rows with their leaves, and the number of leaves to visit."""

    tree: Tree
    rows: DataFrame
    dim: int
    held: np.ndarray
    visits: int = 1


def build(rows: DataFrame, calibrate: Column, k: int = 20, recall: float = RECALL, sample: int = SAMPLE) -> Index:
    """Index every row of ``rows`` (vec_id, vector); ``calibrate`` tells which of them may serve to calibrate.

    Repeated rows count as one.  The tree is learned from the ``sample`` rows with the smallest hashes of their ids.
    """
    rows, dim = same_length(rows.select("vec_id", "vector").distinct(), "vector", 0.0)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()
    tree = grow(matrix(drawn.column("vector"), dim) if dim else np.zeros((0, 1)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(matrix(batch.column("vector"), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], ["vec_id", "vector", "leaf"])

    placed = saved(rows.mapInArrow(work, "vec_id long, vector array<double>, leaf int"))
    held = np.zeros(max(1, tree.leaves), np.int64)
    for leaf, count in placed.groupBy("leaf").count().collect():  # one row per leaf of the tree
        held[leaf] = count
    index = Index(tree, placed, dim, held)
    if tree.leaves:
        index.visits = _visits(index, placed.filter(calibrate), k, recall)
    return index


def _visits(index: Index, able: DataFrame, k: int, recall: float) -> int:
    """Leaves to visit so that ``recall`` of the true neighbours of the calibrating queries are in them."""
    some = able.orderBy(F.xxhash64(F.lit("calibrate"), "vec_id"), "vec_id").limit(CALIBRATE).select("vec_id", "vector").toArrow()
    if not some.num_rows:
        return index.tree.leaves
    ids, queries = some.column("vec_id").to_numpy(), matrix(some.column("vector"), index.dim)
    true: dict[int, list[int]] = {}
    for row in true_neighbours(index.rows, ids, queries, k).collect():
        true.setdefault(row[0], []).append(row[1])
    places = []  # when each true neighbour's leaf is visited
    for i, query in zip(ids.tolist(), queries):
        at = {leaf: n + 1 for n, leaf in enumerate(index.tree.visit(query, index.tree.leaves, index.held, 0))}
        places += [at[leaf] for leaf in true.get(i, [])]
    return int(np.quantile(places, recall, method="higher")) if places else index.tree.leaves


def search(index: Index, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query, by inner product.

    ``queries`` has query_id and vector.  Rows with the query's id are not candidates; ties go to the smaller
    vec_id.  Repeated queries count as one; a candidate comes once with each of its scores.  Copies of a vector are all indexed; of each, the k + 1 smallest ids can be results.  Visits go
    on until k + 1 rows are seen, so that all candidates come back where there are fewer than ``k``.
    """
    tree, dim, held, visits = index.tree, index.dim, index.held, index.visits
    group, blocks = _grouped(held)
    queries = queries.select("query_id", F.concat(F.col("vector"), F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vector"))).alias("vector")).distinct()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query goes once to each group of leaves, with the leaves that it visits there."""
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                places, groups, leaves = [], [], []
                for i, query in enumerate(matrix(some.column("vector"), dim)):
                    there: dict[int, list[int]] = {}
                    for leaf in tree.visit(query, visits, held, k + 1):
                        for g in range(group[leaf], group[leaf] + blocks[leaf]):
                            there.setdefault(g, []).append(leaf)
                    places += [i] * len(there)
                    groups += there.keys()
                    leaves += there.values()
                yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int32()), pa.array(leaves, pa.list_(pa.int32())), *some.take(pa.array(places, pa.int32())).columns], ["place", "leaves", "query_id", "vector"])

    asked = queries.mapInArrow(route, "place int, leaves array<int>, query_id long, vector array<double>")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, ids = batch.column("leaf").to_numpy(), batch.column("vec_id").to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((group[leaf] + ids % blocks[leaf]).astype(np.int32))], [*batch.schema.names, "place"])

    items = index.rows.mapInArrow(deal, "vec_id long, vector array<double>, leaf int, place int")

    def answer(rows: pa.Table, wanted: pa.RecordBatch) -> pa.RecordBatch:
        ids, leaf, own = rows.column("vec_id").to_numpy(), rows.column("leaf").to_numpy(), wanted.column("query_id").to_numpy()
        visited = np.zeros((len(own), len(held)), bool)
        for i, leaves in enumerate(wanted.column("leaves").to_pylist()):
            visited[i, leaves] = True
        query, places, score = _local(ids, matrix(rows.column("vector"), dim), own, matrix(wanted.column("vector"), dim), k, visited[:, leaf])
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids[places]), pa.array(score)], ["query_id", "vec_id", "score"])

    groups = int((group + blocks).max(initial=1))
    return ranked(meet(items, asked, groups, lambda rows: rows.combine_chunks(), answer, "query_id long, vec_id long, score double"), k)


def _grouped(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each leaf: neighbouring leaves share one, a large leaf is split into several."""
    group, blocks = np.zeros(len(held), np.int64), np.maximum(1, -(-held // ROWS))
    now, room = 0, ROWS
    for leaf, rows in enumerate(held.tolist()):
        if rows > room and room < ROWS:
            now, room = now + 1, ROWS
        group[leaf] = now
        if blocks[leaf] > 1:
            now, room = now + int(blocks[leaf]), ROWS
        else:
            room -= rows
    return group, blocks
