"""Landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    separator: str = ",",
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV file(s) with a header.

    Without a schema all columns are text, ready for ``conform``; ``infer=True``
    pays one more scan to guess types.  With a schema, the header has to name its
    columns in their order, else the query fails; ``corrupt_column`` keeps the
    raw text of lines that do not fit it.
    """
    reader = spark.read.option("header", True).option("sep", separator)
    if schema is not None:
        if corrupt_column:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema).option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_binary(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Files as rows ``path, modificationTime, length, content``.

    ``content`` is only read by plans that select it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
