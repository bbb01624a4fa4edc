"""Sources and sinks: what was written comes back."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato.functions.text import file_extension, file_name
from estrato.operators.shape import conform
from estrato.operators.tables import delete_where
from estrato.schemas import struct_of
from estrato.session import new_shared_folder
from estrato.sources.landing import read_binary, read_landing
from estrato.sources.layers import Layer
from estrato.sources.snapshots import SnapshotTable
from estrato.workload import cleaning
from estrato.workload.registry import Tables, query


@query("landing_csv", "SELECT * FROM supplier")
def landing_csv(t: Tables):
    """A table written as CSV text and conformed to its declared types again."""
    path = f"{new_shared_folder(t.spark)}/supplier"
    t.supplier.write.option("header", True).csv(path)
    types = {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"}
    return conform(read_landing(t.spark, path), types)


@query("layer_table", f"WITH {cleaning.POLICIES} SELECT * FROM policies_clean")
def layer_table(t: Tables):
    """A silver table written, and overwritten under the same schema."""
    silver = Layer(t.spark, "silver", new_shared_folder(t.spark))
    silver.write(cleaning.policies(t), "policies_clean")
    return silver.write(cleaning.policies(t), "policies_clean", evolve=False)


def customers_snapshots(t: Tables) -> SnapshotTable:
    table = SnapshotTable(t.spark, f"{new_shared_folder(t.spark)}/customer")
    table.commit(t.customer, "CREATE")
    table.commit(delete_where(table.read(), "c_acctbal < 0"), "DELETE")
    table.restore(0)
    return table


@query(
    "table_history",
    "SELECT CAST(v AS BIGINT) AS version, op AS operation, "
    "(SELECT count(*) FROM customer WHERE v <> 1 OR NOT c_acctbal < 0) AS rows "
    "FROM (VALUES (0, 'CREATE'), (1, 'DELETE'), (2, 'RESTORE 0')) h(v, op)",
)
def table_history(t: Tables):
    return customers_snapshots(t).history().select("version", "operation", "rows")


@query("table_version", "SELECT * FROM customer WHERE NOT c_acctbal < 0")
def table_version(t: Tables):
    return customers_snapshots(t).read(version=1)


@query("table_restore", "SELECT * FROM customer")
def table_restore(t: Tables):
    return customers_snapshots(t).read()


_PER_FILE = 100


@query(
    "binary_files",
    f"SELECT c_custkey // {_PER_FILE} AS block, 'txt' AS extension, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS length, "
    f"sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY 1",
)
def binary_files(t: Tables):
    """Files of the names of a hundred customers each, read back as binary rows: name, size and bytes."""
    path = f"{new_shared_folder(t.spark)}/customer"
    lines = t.customer.select(F.col("c_name").alias("value"), F.expr(f"c_custkey div {_PER_FILE}").alias("block"), "c_custkey")
    # A block is one file of one task, its lines in order.
    lines = lines.repartition("block").sortWithinPartitions("block", "c_custkey").drop("c_custkey")
    lines.write.partitionBy("block").text(path)
    files = read_binary(t.spark, path, glob="*.txt")
    return files.select(
        F.regexp_extract("path", "block=([0-9]+)", 1).cast("bigint").alias("block"),
        file_extension(file_name(F.col("path"))).alias("extension"),
        "length",
        F.sha2("content", 256).alias("sha256"),
    )


@query("landing_csv_inferred", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem")
def landing_csv_inferred(t: Tables):
    """Types found by looking at the text: whole numbers, fractions, words and days."""
    path = f"{new_shared_folder(t.spark)}/lineitem"
    written = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.col("l_shipdate").cast("date"))
    written.write.option("header", True).csv(path)
    found = read_landing(t.spark, path, infer=True)
    kinds = dict(found.dtypes)
    # What the text says, not what the file it came from said, decides; widths follow the largest value.
    assert {kinds[c] for c in ("l_orderkey", "l_linenumber")} <= {"int", "bigint"} and kinds["l_shipdate"] == "date"
    types = {f.name: f.dataType.simpleString() for f in written.schema}
    return found.select(*[F.col(c).cast(types[c]).alias(c) for c in written.columns])


_LINES = "SELECT *, s_suppkey % 7 = 0 AS broken FROM supplier"


@query(
    "landing_csv_declared",
    f"SELECT CASE WHEN NOT broken THEN s_suppkey END AS s_suppkey, s_name, s_acctbal, "
    f"CASE WHEN broken THEN 'no ' || CAST(s_suppkey AS VARCHAR) || ';' || s_name || ';' || CAST(s_acctbal AS VARCHAR) END AS broken_line FROM ({_LINES})",
)
def landing_csv_declared(t: Tables):
    """Declared types, a separator, and lines that do not fit kept as they are."""
    path = f"{new_shared_folder(t.spark)}/supplier"
    key = F.when(F.col("s_suppkey") % 7 == 0, F.concat(F.lit("no "), F.col("s_suppkey").cast("string"))).otherwise(F.col("s_suppkey").cast("string"))
    t.supplier.select(key.alias("s_suppkey"), "s_name", "s_acctbal").write.option("header", True).option("sep", ";").csv(path)
    schema = struct_of({"s_suppkey": "bigint", "s_name": "string", "s_acctbal": "double"})
    return read_landing(t.spark, path, schema, separator=";", corrupt_column="broken_line")
