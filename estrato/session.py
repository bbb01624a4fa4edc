"""Session settings the operators are written for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# ANSI mode turns silent NULLs into errors, so each operator says where a bad
# value may become NULL.  Adaptive execution splits skewed join partitions and
# sizes shuffles at run time.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet is compressed: count a file as this many times its size when
    # deciding whether a side is small enough to broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def session(app: str = "estrato", master: str | None = None, **extra: str) -> SparkSession:
    """Session with ``SETTINGS``; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``, and only where it is unset the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def _delete(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if at_exit:
        files.mkdirs(place)
        files.deleteOnExit(place)
    else:
        files.delete(place, True)


def new_shared_folder(spark: SparkSession) -> str:
    """A fresh path for written tables below the shared folder; what is left of them goes when the application ends."""
    own = f"{shared_root(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"
    _delete(spark, own, at_exit=True)
    return f"{own}/cut-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read on from there, only the columns that are used."""
    path = new_shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete a table made by ``cut_lineage`` that nothing will read again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/cut-" in folder:
            _delete(df.sparkSession, folder)
