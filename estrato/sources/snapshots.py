"""A table kept as one parquet folder per version, with its history."""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.schemas import empty_table, struct_of
from estrato.sources.files import Files

HISTORY = {"version": "bigint", "committed_at": "timestamp", "operation": "string", "rows": "bigint", "folder": "string"}


class SnapshotTable:
    """Versions 0, 1, ... of a table below ``path``.

    A commit writes a folder of its own and then publishes its history row, under the number of its version, as a file
    that appears whole and that only one writer can make.  That file is the commit: a writer lost before it leaves a
    folder nobody reads, one lost after it has committed, and neither is in the way of the next one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path, Files(spark, path)

    def history(self) -> DataFrame:
        """One row per version."""
        if not self.files.exists("history"):
            return empty_table(self.spark, HISTORY)
        return self.spark.read.schema(struct_of(HISTORY)).json(f"{self.path}/history")

    def _latest(self, condition=None) -> int | None:
        past = self.history() if condition is None else self.history().filter(condition)
        return past.agg(F.max("version")).first()[0]

    def commit(self, df: DataFrame, operation: str) -> int:
        """Store ``df`` as the next version and return its number.

        Of two writers that saw the same last version one gets ``FileExistsError``.
        """
        last = self._latest()
        version = 0 if last is None else last + 1
        folder = f"{self.path}/versions/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        rows = self.spark.read.schema(df.schema).parquet(folder).count()
        now = datetime.datetime.now(datetime.UTC).isoformat(timespec="microseconds")
        row = {"version": version, "committed_at": now, "operation": operation, "rows": rows, "folder": folder}
        self.files.publish(f"history/version={version:020d}.json", json.dumps(row), replace=False)
        return version

    def read(self, version: int | None = None, timestamp: str | None = None) -> DataFrame:
        """Latest version, the given one, or the one valid at ``timestamp``."""
        if version is not None:
            found = self._latest(F.col("version") == version)
        elif timestamp is not None:
            found = self._latest(F.col("committed_at") <= F.lit(timestamp).cast("timestamp"))
        else:
            found = self._latest()
        if found is None:
            raise ValueError(f"no such version of {self.path}")
        folder = self.history().filter(F.col("version") == found).first()["folder"]
        return self.spark.read.parquet(folder)

    def restore(self, version: int) -> int:
        """Make an old version the newest one."""
        return self.commit(self.read(version=version), f"RESTORE {version}")
