"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once; longer single texts are one slice of their own.
SLICE_BYTES = 1 << 20
#: Bits of a bitmap that drivers and tasks exchange: 4 MB.
SIEVE = 1 << 25


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the folder that all machines share; it goes when the application ends.

    That is ``spark.checkpoint.dir``; only where it is unset, as in tests, the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    own = f"{root.rstrip('/')}/estrato-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{own}/estrato-{uuid.uuid4().hex}"


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing holds any more: it does when the driver collects garbage.

    The first collection finds the plans, the second what they held.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and survives lost executors.

    Tables written before made the shuffle files behind them useless; they go first.
    """
    free_shuffles(df.sparkSession)
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """As ``written``, but shuffle files behind earlier tables stay until Spark's own cleaning."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing will read again."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/estrato-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def importable(spark: SparkSession) -> None:
    """Let Python workers that start on this machine import this package from where it is."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def meet(rows: DataFrame, queries: DataFrame, places: int, build: Callable, answer: Callable, schema: str) -> DataFrame:
    """``answer(build(rows of a place), queries of the place)`` for all places from 0 to ``places`` - 1, their column ``place``.

    Every row moves once, every query to the places it names.  In a partition the rows of a place come first and are
    built once; the queries follow as a stream, and are answered batch by batch.  So a task holds the rows of one
    place and one batch of queries, however many queries there are.  Rows without queries give nothing, and neither do
    queries without rows.  Columns that only one of the two has are null for the other.
    """
    both = rows.withColumn("asks", F.lit(False)).unionByName(queries.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    # Each partition is one place, so no hash deals two of them to one task.
    placed = both.repartitionById(places, F.col("place")).sortWithinPartitions("place", "asks")
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, built = [], None, None
        for batch in batches:
            place, asks = batch.column("place").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(place) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if start == end:
                    continue
                if place[start] != current:
                    held, current, built = [], place[start], None
                part = batch.slice(start, end - start)
                if not asks[start]:
                    held.append(part.select(names))
                    continue
                if built is None and held:
                    built, held = build(pa.Table.from_batches(held)), []
                if built is not None:
                    yield answer(built, part)

    return placed.mapInArrow(work, schema)


def sieve(rows: DataFrame, column: str) -> np.ndarray:
    """A bitmap of bounded size (``SIEVE`` bits) in which the bit of every value of a column of hashes is set.

    It lets tasks leave out most rows that a join would drop; the join that follows makes the result right.
    """
    place = (F.pmod(F.col(column), F.lit(SIEVE)) + 1).alias("place")  # Spark counts places in bitmaps from 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    found = rows.select(place).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(bits).collect()
    out = np.zeros((SIEVE // 32768, 4096), np.uint8)
    for bucket, row in found:
        out[bucket - 1] = np.frombuffer(bytes(row), np.uint8)
    return out.ravel()


def in_sieve(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.view(np.uint64) % np.uint64(SIEVE)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` with about ``limit`` bytes of ``column`` each."""
    if not batch.num_rows:
        return
    offsets = text_buffers(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = max(start + 1, min(end, batch.num_rows))
        yield batch.slice(start, end - start)
        start = end


def text_buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the offsets of each; a null is empty."""
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    if values.null_count:
        values = values.fill_null("" if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) else b"")
    _, places, data = values.buffers()
    kind = np.int64 if wide else np.int32
    if places is None or not len(values):
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    offsets = np.frombuffer(places, kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def is_space(data: np.ndarray) -> np.ndarray:
    """ASCII white space: the blank and bytes 9 to 13."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words before each text (one more at the end).

    A word is a longest run of bytes other than ASCII white space inside one text.
    """
    inside = ~is_space(data)
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]``, whatever stands around it.

    Prefix sums of ``value * base**position`` modulo 2**64, brought to position 0 by the inverse of the base.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(base, len(values)), out=total[1:])
        back = _powers(_inverse(base), len(values))
        return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


#: Two independent families of hashes: odd bases for bytes in words and for words in runs.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    letters = mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(1000 * family))
    return run_hashes(letters[data], starts, ends, BYTE_BASES[family])
