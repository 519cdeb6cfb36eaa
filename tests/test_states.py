"""Numbered states of the Parquet warehouse: refreshes that die, that meet, and what is left of them."""

import pytest
from pyspark.sql import functions as F

from starmart import config, storage
from starmart.operators import dimensions as D
from starmart.plans import catalog as C
from starmart.plans import facts as FT
from starmart.session import materialize, new_scratch_dir, scratch_scope
from starmart.sources.warehouse import Conflict, ParquetWarehouse
from tests.conftest import rows


def made(spark):
    return ParquetWarehouse(spark, new_scratch_dir(spark, "test-states"))


def days(spark, *pairs):
    return spark.createDataFrame(list(pairs), "DayKey int, n bigint")


def test_refresh_is_seen_whole_or_not_at_all(spark):
    wh = made(spark)
    wh.write_fact(days(spark, (1, 10), (2, 20)), "f")
    other = ParquetWarehouse(spark, wh.root)
    with wh.refresh():
        wh.write_fact(days(spark, (2, 21), (3, 30)), "f")
        wh.clear_days("f", [1])
        wh.write(spark.range(3), "t")
        assert rows(wh.read("f"), "DayKey", "n") == [(2, 21), (3, 30)]  # its own changes
        assert rows(other.read("f"), "DayKey", "n") == [(1, 10), (2, 20)] and not other.exists("t")
    assert rows(other.read("f"), "DayKey", "n") == [(2, 21), (3, 30)] and other.read("t").count() == 3


def test_refresh_that_fails_between_write_and_clear_leaves_the_old_state(spark):
    wh = made(spark)
    wh.write_fact(days(spark, (1, 10), (2, 20)), "f")
    with pytest.raises(KeyError), wh.refresh():
        wh.write_fact(days(spark, (2, 21)), "f")
        raise KeyError("lost")
    again = ParquetWarehouse(spark, wh.root)
    assert rows(again.read("f"), "DayKey", "n") == rows(wh.read("f"), "DayKey", "n") == [(1, 10), (2, 20)]
    assert again.vacuum() == 1 and rows(again.read("f"), "DayKey", "n") == [(1, 10), (2, 20)]


def test_counts_come_from_the_stored_files_and_failures_raise(spark, sf, monkeypatch):
    """A refresh whose count fails raises and the fact keeps its rows."""
    wh = made(spark)
    spec = FT.headcount_fact(C.AS_OF)
    n = FT.update_fact(spec, wh, C._loaded(spark, sf))
    before = rows(wh.read(spec.name))
    assert n == len(before) > 0
    kept = ParquetWarehouse.write_fact

    def fails(self, *args, **kwargs):
        kept(self, *args, **kwargs)
        raise RuntimeError("count failed")

    monkeypatch.setattr(ParquetWarehouse, "write_fact", fails)
    with pytest.raises(RuntimeError, match="count failed"):
        FT.update_fact(spec, wh, C._loaded(spark, sf).where("month = 1"))
    assert rows(wh.read(spec.name)) == before


def test_rerun_without_rows_leaves_an_empty_readable_fact(spark, sf):
    wh = made(spark)
    spec = FT.headcount_fact(C.AS_OF)
    assert FT.update_fact(spec, wh, C._loaded(spark, sf)) > 0
    assert FT.update_fact(spec, wh, C._loaded(spark, sf).withColumn("is_active", F.lit(False))) == 0
    assert wh.read(spec.name).count() == 0 and "EmployeeCount" in wh.read(spec.name).columns
    assert wh.read(config.EMPLOYEE_DETAIL).count() > 0  # kept


def test_publishers_that_meet(spark):
    a = made(spark)
    a.write(spark.range(1), "t")
    b = ParquetWarehouse(spark, a.root)
    with a.refresh():  # other tables: both changes stand
        a.write(spark.range(5), "x")
        b.write(spark.range(7), "y")
    assert a.read("x").count() == 5 and a.read("y").count() == 7
    with pytest.raises(Conflict), a.refresh(rely_on=["t"]):
        a.write(spark.range(1), "t")
        b.write(spark.range(1), "t")
    assert a.read("t").count() == 2
    assert a.state()[0] == 4


def test_only_one_creates_a_file(spark):
    path = f"{made(spark).root}/n.json"
    assert storage.create_new(spark, path, "é1") and not storage.create_new(spark, path, "2")
    assert storage.read_text(spark, path) == "é1" and storage.children(spark, path.rpartition("/")[0]) == ["n.json"]


def test_merge_is_repeated_against_newer_tables(spark, monkeypatch):
    people = spark.createDataFrame([("a", 2024, 1, 1), ("b", 2024, 1, 1)], "gender string, year int, month int, day int")
    wh = made(spark)
    FT.merge_dimensions(wh, people.where("gender = 'a'"), [D.GENDER])
    plain, met = FT.append_members, []

    def meets(warehouse, members, specs, compat):
        counts = plain(warehouse, members, specs, compat)
        if not met:
            met.append(1)
            other = people.withColumn("gender", F.when(F.col("gender") == "b", "B").otherwise("c"))
            FT.merge_dimensions(ParquetWarehouse(spark, wh.root), other, [D.GENDER])
        return counts

    monkeypatch.setattr(FT, "append_members", meets)
    assert FT.merge_dimensions(wh, people, [D.GENDER]) == {D.GENDER.name: 0}
    assert rows(wh.read(D.GENDER.name)) == [(1, "a"), (2, "B"), (3, "c")] and wh.unique(D.GENDER.name)


def test_days_of_a_folder_are_replaced_one_by_one(spark):
    wh = made(spark)
    assert wh.write_fact(days(spark, (1, 10), (2, 20), (2, 21), (3, 30)), "f") == {1: 1, 2: 2, 3: 1}
    wh.write_fact(days(spark, (2, 5)), "f")
    assert rows(wh.read("f"), "DayKey", "n") == [(1, 10), (2, 5), (3, 30)]
    assert wh.clear_days("f", [1, 2, 9]) == [1, 2] and rows(wh.read("f"), "DayKey", "n") == [(3, 30)]
    assert wh.vacuum() == 1 and rows(wh.read("f"), "DayKey", "n") == [(3, 30)]
    wh.write_fact(days(spark, (3, 31), (4, 40)), "f")
    assert rows(wh.read("f"), "DayKey", "n") == [(3, 31), (4, 40)] and len(wh.state()[1]["f"]["folders"]) == 1
    plan = wh.read("f").where("DayKey = 4")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(DayKey,4)" in plan  # skipped by the files' statistics


def test_plain_folder_is_read_and_taken_over(spark):
    wh = made(spark)
    spark.range(4).write.parquet(wh.location("t"))
    assert wh.exists("t") and wh.read("t").count() == 4 and not wh.unique("t")
    wh.write(spark.range(2), "t")
    assert wh.read("t").count() == 6
    days(spark, (1, 1), (2, 2)).write.partitionBy("DayKey").parquet(wh.location("f"))
    wh.write_fact(days(spark, (2, 5)), "f")
    assert rows(wh.read("f"), "DayKey", "n") == [(1, 1), (2, 5)]


def test_compat_merge_is_not_taken_for_unique(spark):
    people = spark.createDataFrame([("a", 2024, 1, 1), ("A", 2024, 1, 1)], "gender string, year int, month int, day int")
    wh = made(spark)
    FT.merge_dimensions(wh, people, [D.GENDER], compat=True)
    FT.merge_dimensions(wh, people, [D.GENDER])
    assert not wh.unique(D.GENDER.name) and wh.read(D.GENDER.name).count() == 2


def test_publish_reads_the_tree_once_and_leaves_no_scratch(spark, sf, monkeypatch):
    source = C._loaded(spark, sf)
    with scratch_scope(spark) as outer:
        held = materialize(spark.range(1), "held")
        frames = []
        plain = FT.fact_frame
        monkeypatch.setattr(FT, "fact_frame", lambda spec, src, *a, **k: frames.append(src) or plain(spec, src, *a, **k))
        wh = made(spark)
        FT.publish(wh, source, C.AS_OF)
        assert held.count() == 1 and [c.split("-")[0] for c in storage.children(spark, outer)] == ["stage", "test"]
        assert len(frames) == 2 and all("/people/" not in f for src in frames for f in src.inputFiles() or [""])
    assert not storage.exists(spark, outer)


def test_headcount_plan_has_one_shuffle_of_people(spark, sf):
    """Lookups of unique dimensions bring no aggregation of their own: what is left joins the customers and sums up."""
    plan = C.fact1_headcount(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") <= 2
    assert plan.count("HashAggregate") == 2
