"""Warehouse I/O. JDBC is checked for the calls it makes, without a database
(this environment runs no database, not even an embedded one)."""

import pytest

from starmart.operators import dimensions as D
from starmart.plans import facts as FT
from starmart.session import new_scratch_dir
from starmart.sources.warehouse import CsvWarehouse, JdbcWarehouse, ParquetWarehouse
from tests.conftest import rows


class _Recorder:
    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


class _FakeSpark:
    def __init__(self):
        self.read = _Recorder()


class _FakeFrame:
    def __init__(self):
        self.write = _Recorder()

    def hint(self, *args):
        return self


def test_jdbc_reader_and_writer_calls():
    spark = _FakeSpark()
    wh = JdbcWarehouse(
        spark, "jdbc:db://h/x", properties={"driver": "D"}, read_options={"fetchsize": "100"},
        write_options={"batchsize": "500"},
    )
    wh.read("dbo.t", options={"numPartitions": "4"})
    assert spark.read.calls[0] == ("options", (), {"fetchsize": "100", "numPartitions": "4"})
    assert spark.read.calls[1] == ("jdbc", ("jdbc:db://h/x", "dbo.t"), {"properties": {"driver": "D"}})
    df = _FakeFrame()
    wh.write(df, "dbo.detail", mode="overwrite", options={"truncate": "true"})
    assert df.write.calls[0] == ("mode", ("overwrite",), {})
    assert df.write.calls[1] == ("options", (), {"batchsize": "500", "truncate": "true"})
    assert df.write.calls[2] == ("jdbc", ("jdbc:db://h/x", "dbo.detail"), {"properties": {"driver": "D"}})
    fact = _FakeFrame()
    wh.write_fact(fact, "dbo.fact")
    assert fact.write.calls[0] == ("mode", ("append",), {})


class _Catalogue:
    """A reader over a list of table names, or one whose database cannot be reached."""

    def __init__(self, tables=None):
        self.tables, self.asked = tables, []

    def jdbc(self, url, query, properties):
        if self.tables is None:
            raise TimeoutError("login timed out")
        self.asked.append(query)
        found = [t for t in self.tables if f"= '{t.split('.')[-1].lower()}'" in query]
        return type("Rows", (), {"isEmpty": staticmethod(lambda: not found)})()


def test_jdbc_table_is_absent_only_if_the_catalogue_lacks_it():
    spark = _FakeSpark()
    wh = JdbcWarehouse(spark, "jdbc:db://h/x")
    spark.read = _Catalogue(["reporting.GenderDim"])
    assert wh.exists("reporting.GenderDim") and not wh.exists("reporting.GradeDim")
    assert "lower(table_schema) = 'reporting'" in spark.read.asked[0]
    spark.read = _Catalogue(None)
    with pytest.raises(TimeoutError):
        wh.exists("reporting.GenderDim")
    with pytest.raises(TimeoutError):  # an outage never reads as an empty table
        wh.read("reporting.GenderDim", schema=D.GENDER.table_schema())


def test_parquet_failures_other_than_absence_raise(spark):
    wh = ParquetWarehouse(spark, "nosuchscheme://bucket/root")
    with pytest.raises(Exception, match="nosuchscheme"):
        wh.exists("t")


def test_store_that_assigns_keys_gets_attributes_only(spark):
    wh = ParquetWarehouse(spark, new_scratch_dir(spark, "test-identity"))
    wh.assigns_keys = True
    src = spark.createDataFrame([("b",), ("B",), (None,)], "gender string")
    FT.merge_dimensions(wh, _dated(src), [D.GENDER])
    assert wh.read(D.GENDER.name).columns == ["name"] and rows(wh.read(D.GENDER.name)) == [(None,), ("B",)]


def _dated(df):
    return df.selectExpr("*", "2024 AS year", "1 AS month", "1 AS day")


def test_one_large_day_is_written_by_several_tasks(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    try:
        wh = ParquetWarehouse(spark, new_scratch_dir(spark, "test-day"))
        fact = spark.range(0, 400_000, 1, 8).selectExpr("20240101 AS DayKey", "uuid() AS v")
        wh.write_fact(fact, "f")
        assert len(wh.read("f").inputFiles()) > 1 and wh.read("f").count() == 400_000
    finally:
        spark.conf.unset(key)


def test_days_without_rows_are_cleared(spark):
    wh = ParquetWarehouse(spark, new_scratch_dir(spark, "test-clear"))
    wh.write_fact(spark.createDataFrame([(20240101, 1), (20240102, 2)], "DayKey int, n bigint"), "f")
    assert wh.clear_days("f", [20240102, 20240105]) == [20240102]
    assert rows(wh.read("f"), "DayKey", "n") == [(20240101, 1)]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from starmart import session

    assert session.is_local("local[*]") and session.is_local("local")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")

    class _Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(type("S", (), {"sparkContext": _Context})())


def test_parquet_append_and_dynamic_fact_overwrite(spark):
    wh = ParquetWarehouse(spark, new_scratch_dir(spark, "test-io"))
    assert not wh.exists("t")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    wh.write(a, "t")
    wh.write(spark.createDataFrame([(2, "y")], "k int, v string"), "t")
    assert rows(wh.read("t")) == [(1, "x"), (2, "y")]
    f1 = spark.createDataFrame([(20240101, 1), (20240102, 2)], "DayKey int, n bigint")
    wh.write_fact(f1, "f")
    wh.write_fact(spark.createDataFrame([(20240102, 5)], "DayKey int, n bigint"), "f")
    assert rows(wh.read("f"), "DayKey", "n") == [(20240101, 1), (20240102, 5)]


def test_csv_round_trip(spark):
    wh = CsvWarehouse(spark, new_scratch_dir(spark, "test-csv"))
    df = spark.createDataFrame([(1, "a b", None), (2, None, 3)], "k int, s string, n bigint")
    wh.write(df, "t", mode="overwrite")
    assert rows(wh.read("t", schema=df.schema)) == rows(df)
    fact = spark.createDataFrame([(1, 20240101), (2, 20240102)], "n bigint, DayKey int")
    for _ in range(2):  # a re-run replaces its days
        wh.write_fact(fact, "f")
    assert rows(wh.read("f", schema=fact.schema)) == rows(fact)
