"""Table changes; the changed rows are derived from the given tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from estrato.operators import tables
from estrato.operators.exact import exact_sums
from estrato.session import new_shared_folder
from estrato.sources.partitions import PartitionedTable
from estrato.workload.registry import Tables, query

# New orders: one per customer, behind all existing keys.
_NEW = (
    "SELECT c_custkey + 1000000000 AS o_orderkey, c_custkey AS o_custkey, 'N' AS o_orderstatus, "
    "c_acctbal AS o_totalprice FROM customer"
)
_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def new_orders(t: Tables):
    return t.customer.selectExpr(
        "c_custkey + 1000000000 AS o_orderkey", "c_custkey AS o_custkey", "'N' AS o_orderstatus", "c_acctbal AS o_totalprice"
    )


@query("table_insert", f"{_ORDERS} UNION ALL {_NEW}")
def table_insert(t: Tables):
    return tables.insert_rows(orders(t), new_orders(t))


@query(
    "table_update",
    "SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice < 50000 THEN 'S' ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN o_totalprice < 50000 THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice FROM orders",
)
def table_update(t: Tables):
    return tables.update_where(
        orders(t), "o_totalprice < 50000", {"o_orderstatus": F.lit("S"), "o_totalprice": "o_totalprice + 10"}
    )


@query("table_delete", f"{_ORDERS} WHERE nullif(o_orderstatus, 'P') IS NULL OR o_orderstatus <> 'F'")
def table_delete(t: Tables):
    # The condition is NULL for status P: those rows stay.
    return tables.delete_where(orders(t), "nullif(o_orderstatus, 'P') = 'F'")


# Changes: every open order gets a NULL price, and the new orders come in.
_CHANGES = (
    "SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders "
    f"WHERE o_orderstatus = 'O' UNION ALL {_NEW}"
)


def changes(t: Tables):
    open_orders = orders(t).filter("o_orderstatus = 'O'")
    changed = open_orders.withColumns({"o_orderstatus": F.lit("U"), "o_totalprice": F.lit(None).cast("double")})
    return changed.unionByName(new_orders(t))


_UPSERT = (
    f"WITH changes AS ({_CHANGES}) SELECT * FROM changes UNION ALL {_ORDERS} "
    "WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)"
)


@query("table_upsert", _UPSERT)
def table_upsert(t: Tables):
    return tables.upsert(orders(t), changes(t), ["o_orderkey"])


@query("table_upsert_bulk", _UPSERT)
def table_upsert_bulk(t: Tables):
    return tables.upsert(orders(t), changes(t), ["o_orderkey"], bulk=True)


# Change log: the orders as version 0, their line items as later versions, returns as deletes.
_LOG = (
    "SELECT o_orderkey AS id, o_totalprice AS amount, 0 AS version, FALSE AS deleted FROM orders UNION ALL "
    "SELECT l_orderkey, l_extendedprice, l_linenumber, l_returnflag = 'R' FROM lineitem"
)


def change_log(t: Tables):
    start = t.orders.selectExpr("o_orderkey AS id", "o_totalprice AS amount", "0 AS version", "false AS deleted")
    later = t.lineitem.selectExpr(
        "l_orderkey AS id", "l_extendedprice AS amount", "l_linenumber AS version", "l_returnflag = 'R' AS deleted"
    )
    return start.unionByName(later)


@query(
    "table_as_of",
    f"WITH log AS ({_LOG}), last AS (SELECT *, row_number() OVER (PARTITION BY id "
    "ORDER BY version DESC, deleted DESC, amount DESC) AS rn FROM log WHERE version <= 3) "
    "SELECT id, amount FROM last WHERE rn = 1 AND NOT deleted",
)
def table_as_of(t: Tables):
    return tables.as_of(change_log(t), ["id"], 3)


_AS_OF_TIME = (
    "WITH last AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, "
    "(event_type = 'error') DESC, event_id DESC) AS rn FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') "
    "SELECT user_id, event_id, value FROM last WHERE rn = 1 AND event_type <> 'error'"
)


@query("table_as_of_time", _AS_OF_TIME)
def table_as_of_time(t: Tables):
    log = t.events.selectExpr("user_id", "event_id", "value", "ts", "event_type = 'error' AS deleted")
    return tables.as_of(log, ["user_id"], F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"), version="ts")


# --- tables whose partitions are folders ---------------------------------------------

_MONTHLY = "SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders)"
_MONTH = "date_format(o_orderdate, 'yyyy-MM') AS month"


def monthly_orders(t: Tables) -> PartitionedTable:
    table = PartitionedTable(t.spark, f"{new_shared_folder(t.spark)}/orders", ["month"])
    table.write(t.orders.selectExpr("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", _MONTH))
    return table


# Orders of March 1995 get a new price, those of every tenth customer there are moved to June 1996.
_MOVED = "o_custkey % 10 = 0"


@query(
    "merge_touched_partitions",
    f"WITH m AS ({_MONTHLY}) SELECT o_orderkey, o_custkey, "
    f"CASE WHEN month = '1995-03' AND {_MOVED} THEN TIMESTAMP '1996-06-15' ELSE CAST(o_orderdate AS TIMESTAMP) END AS o_orderdate, "
    "CASE WHEN month = '1995-03' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
    f"CASE WHEN month = '1995-03' AND {_MOVED} THEN '1996-06' ELSE month END AS month FROM m "
    "UNION ALL SELECT c_custkey + 1000000000, c_custkey, TIMESTAMP '1996-06-15', c_acctbal, '1996-06' FROM customer",
)
def merge_touched_partitions(t: Tables):
    table = monthly_orders(t)
    day = t.orders.schema["o_orderdate"].dataType.simpleString()
    later = f"CAST('1996-06-15' AS {day})"
    march = table.read().filter("month = '1995-03'").selectExpr(
        "o_orderkey", "o_custkey", f"CASE WHEN {_MOVED} THEN {later} ELSE o_orderdate END AS o_orderdate", "o_totalprice + 1 AS o_totalprice"
    )
    new = t.customer.selectExpr("c_custkey + 1000000000 AS o_orderkey", "c_custkey AS o_custkey", f"{later} AS o_orderdate", "c_acctbal AS o_totalprice")
    table.merge(march.unionByName(new).selectExpr("*", _MONTH), ["o_orderkey"])
    return table.read().withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("pruned_months", f"WITH m AS ({_MONTHLY}) SELECT month, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) AS total FROM m WHERE month BETWEEN '1995-03' AND '1995-08' GROUP BY month")
def pruned_months(t: Tables):
    """A filter on the folders of a partitioned table: the others are never listed."""
    chosen = monthly_orders(t).read().filter("month BETWEEN '1995-03' AND '1995-08'")
    return exact_sums(chosen, ["month"], {"total": "o_totalprice"}, {"n": ("count", "o_orderkey")})


def _day(time):
    return F.to_date(time)


def event_intervals(t: Tables):
    log = t.events.selectExpr("user_id", "event_id", "value", "ts", "event_type = 'error' AS deleted")
    rows = tables.with_ends(tables.intervals(log, ["user_id"], _day(F.col("ts")), version="ts"), _day, datetime.date(9999, 1, 1))
    table = PartitionedTable(t.spark, f"{new_shared_folder(t.spark)}/events", ["ends"])
    return table.write(rows)


@query("as_of_intervals", _AS_OF_TIME)
def as_of_intervals(t: Tables):
    """The state at a time from a table of intervals: folders that ended before are not read."""
    return tables.valid_at(event_intervals(t), F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"), _day)
