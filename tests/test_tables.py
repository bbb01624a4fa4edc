"""Table changes, as-of reads, layers, snapshots, landing files."""

import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estrato import schemas
from estrato.functions.sql import register_functions
from estrato.operators import tables
from estrato.plans import sales
from estrato.session import cut_lineage
from estrato.sources.landing import read_binary, read_landing
from estrato.sources.layers import Layer, stamp
from estrato.sources.snapshots import SnapshotTable

PRODUCTS = [("1", "2025-01-01", "Mouse", 1, 10.0), ("3", "2025-01-02", "Monitor", 2, 20.0), (None, None, "Webcam", None, 5.0)]


@pytest.fixture
def products(spark):
    return spark.createDataFrame(PRODUCTS, schemas.struct_of(schemas.PRODUCTS))


def test_insert_converts_to_table_types(spark, products, rows):
    new = spark.createDataFrame([(120000.5, 3, "Torre", "A001")], "precio double, cantidad bigint, producto string, id string")
    out = tables.insert_rows(products, new)
    assert out.dtypes == products.dtypes
    assert ("A001", None, "Torre", 3, 120000.5) in rows(out)


def test_update(products, rows):
    out = tables.update_where(products, "id = '1'", {"cantidad": F.lit(5), "precio": "precio * 2"})
    assert rows(out, "id", "cantidad", "precio") == [(None, None, 5.0), ("1", 5, 20.0), ("3", 2, 20.0)]


def test_delete_keeps_rows_with_null_condition(products, rows):
    assert rows(tables.delete_where(products, "id = '1'"), "id") == [(None,), ("3",)]


def test_upsert(spark, products, rows):
    # Keys come as numbers and are converted to the table's text.
    new = spark.createDataFrame(
        [(3, "2025-05-24", "Monitor", 1, None), (4, "2025-05-24", "Impresora", 2, 89.99), (None, None, "Free", 1, 1.0)],
        "id int, fecha string, producto string, cantidad int, precio double",
    )
    for bulk in (False, True):
        out = tables.upsert(products, new, ["id"], bulk)
        assert rows(out, "id", "producto", "precio") == [
            (None, "Free", 1.0), (None, "Webcam", 5.0), ("1", "Mouse", 10.0), ("3", "Monitor", None), ("4", "Impresora", 89.99),
        ]
        with pytest.raises(Exception, match="repeats 2 times"):
            tables.upsert(products, new.unionByName(new.filter("id = 3")), ["id"], bulk).collect()


cells = st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 3))), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=cells, new=cells)
def test_upsert_twice_is_upsert_once(spark, old, new):
    old, new = dict(old), dict(new)
    table = spark.createDataFrame(list(old.items()), "k int, v int")
    change = spark.createDataFrame(list(new.items()), "k int, v int")
    once = tables.upsert(table, change, ["k"])
    assert dict(map(tuple, once.collect())) == {**old, **new}
    assert dict(map(tuple, tables.upsert(once, change, ["k"], bulk=True).collect())) == {**old, **new}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(changes=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.booleans()), max_size=10), at=st.integers(-1, 10))
def test_as_of_replays_the_log(spark, changes, at):
    log = [(k, v, n, gone) for n, (k, v, gone) in enumerate(changes)]
    state = {}
    for k, v, n, gone in log:
        if n <= at:
            state.pop(k, None)
            if not gone:
                state[k] = v
    df = spark.createDataFrame(log, "k int, v int, version int, deleted boolean")
    assert dict(map(tuple, tables.as_of(df, ["k"], at).collect())) == state


@pytest.mark.parametrize("in_folder", [True, False])
def test_layer(spark, products, rows, tmp_path, in_folder):
    layer = Layer(spark, f"layer_{in_folder}".lower(), str(tmp_path) if in_folder else None)
    assert layer.tables() == [] and not layer.exists("p")
    assert rows(layer.read_or_empty("p", schemas.PRODUCTS)) == []
    assert layer.read_or_empty("p", schemas.PRODUCTS).dtypes == products.dtypes
    assert rows(layer.write(products, "p")) == rows(products)
    assert layer.tables() == ["p"] and rows(layer.read_or_empty("p", schemas.PRODUCTS)) == rows(products)
    with pytest.raises(ValueError, match="precio: double -> int"):
        layer.write(products.withColumn("precio", F.col("precio").cast("int")), "p", evolve=False)
    layer.write(products.select("precio", "id", "fecha", "producto", "cantidad"), "p", evolve=False)
    assert layer.write(products.drop("precio"), "p").columns == ["id", "fecha", "producto", "cantidad"]
    layer.write(products.filter("id IS NOT NULL"), "q", partition_by=["producto"])
    assert layer.read("q").filter("producto = 'Mouse'").count() == 1


def test_stamp(products):
    assert stamp(products).dtypes[-1] == ("ingestion_time", "timestamp")


def test_snapshots(spark, products, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert rows(table.history()) == []
    with pytest.raises(ValueError):
        table.read()
    assert table.commit(products, "CREATE") == 0
    assert table.commit(tables.delete_where(table.read(), "id = '1'"), "DELETE") == 1
    assert rows(table.read(), "id") == [(None,), ("3",)]
    assert rows(table.read(version=0), "id") == [(None,), ("1",), ("3",)]
    first = table.history().filter("version = 0").first().committed_at
    assert rows(table.read(timestamp=str(first)), "id") == rows(products, "id")
    with pytest.raises(ValueError):
        table.read(timestamp="1999-01-01")
    assert table.restore(0) == 2 and rows(table.read()) == rows(products)
    assert rows(table.history(), "version", "operation", "rows") == [(0, "CREATE", 3), (1, "DELETE", 2), (2, "RESTORE 0", 3)]


def test_landing(spark, rows, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("id;n\nA001;1\nB;x\n")
    assert rows(read_landing(spark, str(path), separator=";")) == [("A001", "1"), ("B", "x")]
    typed = read_landing(spark, str(path), schemas.struct_of({"id": "string", "n": "int"}), separator=";", corrupt_column="bad")
    assert rows(typed.cache()) == [("A001", 1, None), ("B", None, "B;x")]
    path.write_text("id,n\n1,2.5\n")
    assert read_landing(spark, str(path), infer=True).dtypes == [("id", "int"), ("n", "double")]


def test_binary(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "dent_1.png").write_bytes(b"123")
    (tmp_path / "note.txt").write_bytes(b"x")
    files = read_binary(spark, str(tmp_path), glob="*.png")
    assert [(r.length, bytes(r.content)) for r in files.collect()] == [(3, b"123")]


def test_lineage_is_cut_in_the_named_folder(spark, rows):
    cut = cut_lineage(spark.range(3))
    assert rows(cut) == [(0,), (1,), (2,)]
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in cut.inputFiles())
    assert "Range" not in cut._jdf.queryExecution().executedPlan().toString()


def test_tutorial(spark, products, rows):
    products.createOrReplaceTempView("productos")
    assert sales.average_price(products, "Mouse", 5.0).first()[0] == 10.0
    assert sales.average_price_sql(spark, "productos", "Mouse", 5.0).first()[0] == 10.0
    assert sales.average_price_sql(spark, "productos", "' OR 1=1 --", 0.0).first()[0] is None
    register_functions(spark)
    assert spark.sql("SELECT fn_mayor_que_10(12), fn_mayor_que_10(12.5)").first()[:] == (False, True)
    sold = spark.createDataFrame([("1", "ES", "Mouse", 2, 10.0), ("2", "ES", "X", 1, 5.0), ("3", "PT", "Mouse", 9, 1.0)], "order_id string, country string, product string, units_sold int, unit_price double")
    assert [tuple(r) for r in sales.by_country(sold).collect()] == [("ES", 3, 25.0), ("PT", 9, 9.0)]
    dim = spark.createDataFrame([("Mouse", "Accesorios")], "product string, categoria string")
    assert rows(sales.with_product(sold, dim), "order_id", "categoria") == [("1", "Accesorios"), ("2", None), ("3", "Accesorios")]


def test_failed_and_self_reading_writes_keep_the_table(spark, products, rows, tmp_path):
    layer = Layer(spark, "safe", str(tmp_path))
    layer.write(products, "p")
    before = rows(layer.read("p"))
    with pytest.raises(Exception):
        layer.write(products.withColumn("precio", F.raise_error("no").cast("double")), "p")
    assert rows(layer.read("p")) == before
    half = layer.read("p").filter("id IS NOT NULL")
    assert rows(layer.write(half, "p")) == [r for r in before if r[0] is not None]
    assert layer.tables() == ["p"]


def test_two_writers_of_one_version(spark, products, rows, tmp_path):
    first, second = (SnapshotTable(spark, str(tmp_path / "t")) for _ in range(2))
    first.commit(products, "CREATE")
    second._latest = lambda *a: None  # it looked before the first commit
    with pytest.raises(FileExistsError):
        second.commit(products.limit(1), "CREATE")
    assert rows(first.read()) == rows(products) and first.history().count() == 1


def test_writers_lost_at_any_step_of_a_commit(spark, products, rows, tmp_path, monkeypatch):
    """Before its history row a commit does not count, behind it it does; the next one works either way."""
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.commit(products, "CREATE")

    def lost(*args, **kwargs):
        raise KeyboardInterrupt

    for step in ("publish", "_rename", "after"):
        lost_one = SnapshotTable(spark, str(tmp_path / "t"))
        if step == "publish":
            lost_one.files.publish = lost
        elif step == "_rename":
            lost_one.files._rename = lost
        try:
            lost_one.commit(products.limit(1), step)
        except KeyboardInterrupt:
            pass
        committed = 1 if step == "after" else 0
        assert table.history().count() == 1 + committed and table.read().count() == (1 if committed else 3)
    assert table.commit(products, "NEXT") == 2 and rows(table.read()) == rows(products)
    assert rows(table.history(), "operation") == [("CREATE",), ("NEXT",), ("after",)]


def test_other_errors_are_not_taken_for_another_writer(spark, products, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "history").write_text("a file where the folder should be")
    table._latest = lambda *a: None
    with pytest.raises(Exception) as error:
        table.commit(products, "CREATE")
    assert not isinstance(error.value, FileExistsError)


@pytest.mark.parametrize("in_folder", [True, False])
def test_readers_never_miss_a_table_that_is_overwritten(spark, products, tmp_path, in_folder):
    root = str(tmp_path) if in_folder else None
    layer, reader = Layer(spark, f"swapped_{in_folder}".lower(), root), Layer(spark, f"swapped_{in_folder}".lower(), root)
    layer.write(products.withColumn("n", F.lit(0)), "p")
    found, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                found.append(reader.read("p").agg(F.count("*"), F.min("n") == F.max("n")).first())
            except Exception as error:
                found.append(error)

    thread = threading.Thread(target=read)
    thread.start()
    for n in range(1, 6):
        layer.write(products.withColumn("n", F.lit(n)), "p")
    stop.set()
    thread.join()
    assert found and [f for f in found if isinstance(f, Exception) or tuple(f) != (3, True)] == []
    assert layer.tables() == ["p"]


@pytest.mark.parametrize("in_folder", [True, False])
def test_old_generations_go(spark, products, rows, tmp_path, in_folder):
    layer = Layer(spark, f"kept_{in_folder}".lower(), str(tmp_path) if in_folder else None, keep=0)
    for n in range(4):
        layer.write(products.limit(n), "p")
    # The last one replaced stays for its readers until it has been out for a while.
    assert len(layer._generations("p")) <= 2 and layer.read("p").count() == 3


def test_a_lost_writer_leaves_the_table(spark, products, rows, tmp_path):
    layer = Layer(spark, "lost", str(tmp_path))
    layer.write(products, "p")

    def lost(*args, **kwargs):
        raise KeyboardInterrupt

    publish, layer.files.publish = layer.files.publish, lost
    for table in ("p", "q"):
        with pytest.raises(KeyboardInterrupt):
            layer.write(products.limit(1), table)
    assert rows(layer.read("p")) == rows(products) and layer.tables() == ["p"] and not layer.exists("q")
    layer.files.publish = publish
    assert layer.write(products.limit(1), "p").count() == 1 and layer.write(products, "q").count() == 3


def test_buckets_and_figures(spark, products, rows):
    layer = Layer(spark, "bucketed")
    written = layer.write(products, "p", bucket_by=(4, ["id"]), figures={"n": F.count("*"), "without": F.count_if(F.col("id").isNull())})
    assert layer.figures["p"] == {"n": 3, "without": 1} and rows(written) == rows(products)
    assert "Exchange hashpartitioning" not in written.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()


def test_as_of_takes_a_null_flag_as_not_deleted(spark):
    log = spark.createDataFrame([(1, 1, None, "a"), (2, 1, False, "b"), (3, 1, True, "c")], "k int, version int, deleted boolean, v string")
    assert sorted(r.k for r in tables.as_of(log, ["k"], 1).collect()) == [1, 2]


def test_columns_that_the_table_has_not(spark, products):
    with pytest.raises(ValueError, match="no such columns: preccio"):
        tables.insert_rows(products, spark.createDataFrame([("A", 1.0)], "id string, preccio double"))


def test_csv_header_has_to_fit_the_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\nB1,A1\n")
    with pytest.raises(Exception):
        read_landing(spark, str(tmp_path / "x.csv"), schemas.struct_of({"a": "string", "b": "string"})).collect()
