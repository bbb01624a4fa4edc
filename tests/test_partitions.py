"""Partitioned tables, merges that rewrite only what they touch, and tables of intervals."""

import datetime as dt
import glob

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estrato.operators import tables
from estrato.sources.partitions import PartitionedTable
from estrato.workload.registry import Tables
from estrato.workload.tables import event_intervals, monthly_orders

SMALL = "/root/testdata/sf0.001"


def _files(path):
    out = {}
    for f in glob.glob(f"{path}/*/*.parquet"):
        out.setdefault(f.split("/")[-2], set()).add(f.split("/")[-1])
    return out


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, tmp_path):
    out = PartitionedTable(spark, str(tmp_path / "t"), ["part"])
    out.write(spark.createDataFrame([(i, f"v{i}", None if i == 9 else f"0{i % 4}") for i in range(10)] + [(None, "no key", "00")], "id int, v string, part string"))
    return out


def test_untouched_partitions_keep_their_files(spark, table, rows):
    before = _files(table.path)
    # 1 changes in place, 2 moves to a new partition, 20 is new in an old one.
    changes = spark.createDataFrame([(1, "new", "01"), (2, None, "07"), (20, "x", "01")], "id int, v string, part string")
    assert sorted(table.merge(changes, ["id"])) == [("01",), ("02",), ("07",)]
    after = _files(table.path)
    assert all(before[p] == after[p] for p in ("part=00", "part=03", "part=__HIVE_DEFAULT_PARTITION__"))
    assert not before["part=01"] & after["part=01"] and not before["part=02"] & after["part=02"]
    want = {i: (f"v{i}", None if i == 9 else f"0{i % 4}") for i in range(10)} | {1: ("new", "01"), 2: (None, "07"), 20: ("x", "01"), None: ("no key", "00")}
    assert {r.id: (r.v, r.part) for r in table.read().collect()} == want
    # The same merge again, as after a lost driver, changes nothing.
    table.merge(changes, ["id"])
    assert {r.id: (r.v, r.part) for r in table.read().collect()} == want


def test_a_partition_that_all_rows_leave_is_gone(spark, table):
    table.merge(spark.createDataFrame([(3, "a", "01"), (7, "b", None)], "id int, v string, part string"), ["id"])
    assert "part=03" not in _files(table.path) and table.read().filter("part = '03'").count() == 0
    assert sorted(r.id for r in table.read().filter("part IS NULL").collect()) == [7, 9]


def test_folder_names_with_marks(spark, tmp_path):
    out = PartitionedTable(spark, str(tmp_path / "t"), ["part"])
    out.write(spark.createDataFrame([(1, "a:b c%+/"), (2, "ü")], "id int, part string"))
    assert out.merge(spark.createDataFrame([(1, "ü")], "id int, part string"), ["id"])
    assert {(r.id, r.part) for r in out.read().collect()} == {(1, "ü"), (2, "ü")} and len(_files(out.path)) == 1


def test_repeated_source_keys_fail_before_anything_is_written(spark, table):
    before = _files(table.path)
    with pytest.raises(Exception, match="repeats 2 times"):
        table.merge(spark.createDataFrame([(1, "a", "01"), (1, "b", "01")], "id int, v string, part string"), ["id"])
    assert _files(table.path) == before
    assert table.merge(table.read().limit(0), ["id"]) == [] and _files(table.path) == before


def test_two_partition_columns(spark, tmp_path):
    out = PartitionedTable(spark, str(tmp_path / "t"), ["a", "b"])
    out.write(spark.createDataFrame([(i, i % 2, i % 3) for i in range(12)], "id int, a int, b int"))
    assert sorted(out.merge(spark.createDataFrame([(0, 1, 1)], "id int, a int, b int"), ["id"])) == [(0, 0), (1, 1)]
    assert {(r.id, r.a, r.b) for r in out.read().collect()} == {(0, 1, 1)} | {(i, i % 2, i % 3) for i in range(1, 12)}


def test_filters_prune_folders(spark):
    table = monthly_orders(Tables(spark, SMALL))
    chosen = table.read().filter("month = '1995-03'")
    assert "PartitionFilters: [isnotnull(month" in _plan(chosen)
    assert len(chosen.select("_metadata.file_path").distinct().collect()) == 1 and len(_files(table.path)) > 70
    states = event_intervals(Tables(spark, SMALL))
    text = _plan(tables.valid_at(states, F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"), lambda c: F.to_date(c)))
    assert "PartitionFilters: [isnotnull(ends" in text and "2024-01-15" in text.split("PartitionFilters")[1].split("]")[0]


log = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.sampled_from([None, True, False]), st.integers(0, 5)), max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(changes=log, at=st.integers(0, 41))
def test_intervals_give_the_state_at_any_version(spark, rows, changes, at):
    df = spark.createDataFrame([(k or None, v, d, x) for k, v, d, x in changes], "k int, version int, deleted boolean, x int")
    block = lambda c: F.floor(c / 10).cast("int")
    states = tables.with_ends(tables.intervals(df, ["k"], block(F.col("version"))), block, 1 << 30)
    assert rows(tables.valid_at(states, at, block)) == rows(tables.as_of(df, ["k"], at))


def test_intervals_of_times_and_a_hot_key(spark):
    start = dt.datetime(2024, 1, 1)
    changes = [("hot", start + dt.timedelta(hours=i), False, i) for i in range(2000)] + [("cold", start, None, -1)]
    df = spark.createDataFrame(changes, "k string, ts timestamp, deleted boolean, x int").repartition(7)
    day = lambda c: F.to_date(c)
    states = tables.with_ends(tables.intervals(df, ["k"], day(F.col("ts")), version="ts"), day, dt.date(9999, 1, 1))
    assert states.filter("valid_to IS NULL").count() == 2 and states.count() == 2001
    found = tables.valid_at(states, F.lit("2024-01-02 05:30:00").cast("timestamp"), day)
    assert sorted(tuple(r) for r in found.collect()) == [("cold", -1), ("hot", 29)]
    # No window sees the hot key as a whole: its rows are dealt by day.
    assert "hashpartitioning(k" in _plan(states) and "_block" in _plan(states)
