"""A table whose partitions are folders: filters read, and merges rewrite, only the folders they touch."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from estrato.operators.shape import conform
from estrato.operators.tables import upsert
from estrato.session import cut_lineage, drop_cut
from estrato.sources.files import Files


class PartitionedTable:
    """Parquet files below ``path`` in one folder per value of the columns ``by``.

    Folder names don't tell types: give the ``schema`` of a table that was not written through this object.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], schema: StructType | None = None):
        self.spark, self.path, self.by, self.schema = spark, path, list(by), schema

    def write(self, df: DataFrame) -> DataFrame:
        """Replace the whole table.  Every task writes few folders: rows are dealt by partition, large ones are split."""
        df.hint("rebalance", *self.by).write.mode("overwrite").partitionBy(*self.by).parquet(self.path)
        self.schema = StructType([*[f for f in df.schema if f.name not in self.by], *[df.schema[c] for c in self.by]])
        return self.read()

    def read(self) -> DataFrame:
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(self.path)

    def _of(self, partitions: Sequence) -> Column:
        """Condition that holds for the rows of some partitions; Spark prunes the other folders by it."""
        if len(self.by) == 1:
            known = [p[0] for p in partitions if p[0] is not None]
            return F.col(self.by[0]).isin(known) | (F.col(self.by[0]).isNull() if len(known) < len(partitions) else F.lit(False))
        each = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(p[c])) for c in self.by]) for p in partitions]
        return reduce(lambda a, b: a | b, each, F.lit(False))

    def merge(self, rows: DataFrame, keys: Sequence[str]) -> list[tuple]:
        """Replace the rows whose key is in ``rows``, add the others, and return the partitions that were rewritten.

        Rewritten are the partitions that hold a changed key, and those that the changes belong to; the files of all
        others stay.  A row whose partition changes moves.  As in ``upsert``, a repeated source key fails the merge
        before anything is written.  The new partitions are complete before the first old one goes; a merge that is
        lost after that is repaired by running it again.  The driver sees the touched partitions, never rows.
        """
        table = self.read()
        changes = cut_lineage(conform(rows, dict(table.dtypes), keep_rest=False, optional=table.columns))
        # Only keys and folders are read to find the partitions.
        held = table.join(changes.select(*keys), list(keys), "left_semi").select(*self.by)
        touched = held.unionByName(changes.select(*self.by)).distinct().collect()
        if touched:
            new = cut_lineage(upsert(table.filter(self._of(touched)), changes, keys, bulk=True))
            left = new.select(*self.by).distinct().collect()
            gone = [p for p in touched if p not in left]
            # Folders that no row stays in are not overwritten, so they are looked up before and deleted after.
            place = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
            empty = [unquote(r.folder) for r in table.filter(self._of(gone)).select(place).distinct().collect()] if gone else []
            writer = new.hint("rebalance", *self.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*self.by).parquet(self.path)
            for folder in empty:
                Files(self.spark, folder).delete("")
            drop_cut(new)
            self.spark.catalog.refreshByPath(self.path)
        drop_cut(changes)
        return [tuple(p) for p in touched]
