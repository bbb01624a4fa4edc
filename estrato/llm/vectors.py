"""Vectors as columns and as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def same_length(rows: DataFrame, column: str, zero: float | int) -> tuple[DataFrame, int]:
    """Shorter vectors filled up with zeros, which changes no inner product, and the common length."""
    low, high = rows.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if low != high:
        rows = rows.withColumn(column, F.concat(F.col(column), F.array_repeat(F.lit(zero), F.lit(high) - F.size(column))))
    return rows, high or 0


def matrix(values: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), dim)


def best(ids: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, best first, ties to smaller ids."""
    if len(scores) > count:
        limit = np.partition(scores, len(scores) - count)[len(scores) - count]
        places = np.flatnonzero(scores >= limit)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:count]


def smallest_ids(ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` smallest ids of each distinct row: no other copy can be among ``count`` results."""
    if not len(ids):
        return np.zeros(0, np.int64)
    keys = np.ascontiguousarray(rows + 0.0).view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel() if rows.shape[1] else np.zeros(len(ids))
    group = np.unique(keys, return_inverse=True)[1].ravel()
    order = np.lexsort((ids, group))
    once = (np.diff(group[order], prepend=-1) != 0) | (np.diff(ids[order], prepend=ids[order[0]]) != 0)  # repeated rows
    order = order[once]
    heads = np.flatnonzero(np.diff(group[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    return order[place < count]


def ranked(found: DataFrame, count: int) -> DataFrame:
    """The ``count`` best of (query_id, vec_id, score) per query, each once, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
