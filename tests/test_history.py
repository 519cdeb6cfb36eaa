import datetime as dt

from pyspark.sql import functions as F

from starmart.operators import history as H
from tests.conftest import rows

SCHEMA = "status string, datasource_name string, etl_name string, data_path string, start timestamp, run_guid string"


def ts(h, m=0):
    return dt.datetime(2024, 1, 5, h, m)


def path(day, hour, guid):
    return f"/d/year=2024/month=01/day={day:02d}/hour={hour:02d}/etlid={guid}/"


def hist(spark, runs):
    data = [("SUCCESS", "Model", "FullUserInfo", path(d, h, g), s, g) for d, h, s, g in runs]
    return H.with_path_parts(spark.createDataFrame(data, SCHEMA))


def latest_all_forms(df):
    a = rows(H.run_keys(H.latest_runs(df)))
    b = rows(H.run_keys(H.latest_runs_ranked(df)))
    w = H.day_first_values(df).filter(
        (F.col("start") == F.col("last_start")) & (F.col("hour") == F.col("last_hour"))
    )
    c = rows(H.run_keys(w))
    assert a == b == c
    return a


def test_successful_runs_filters_status_source_and_etl(spark):
    data = [
        ("SUCCESS", "Model", "FullUserInfo", path(1, 1, "a"), ts(1), "a"),
        ("FAILED", "Model", "FullUserInfo", path(1, 2, "b"), ts(2), "b"),
        ("SUCCESS", "Report", "FullUserInfo", path(1, 3, "c"), ts(3), "c"),
        ("SUCCESS", "Model", "Other", path(1, 4, "d"), ts(4), "d"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert [r["run_guid"] for r in H.successful_runs(df).collect()] == ["a"]


def test_latest_run_greatest_hour_then_start(spark):
    df = hist(spark, [(5, 3, ts(3), "early"), (5, 9, ts(9, 1), "late-a"), (5, 9, ts(9, 30), "late-b")])
    assert latest_all_forms(df) == [(2024, 1, 5, 9, "late-b")]


def test_exact_ties_all_survive(spark):
    df = hist(spark, [(5, 9, ts(9, 5), "x"), (5, 9, ts(9, 5), "y"), (5, 2, ts(2), "z")])
    assert latest_all_forms(df) == [(2024, 1, 5, 9, "x"), (2024, 1, 5, 9, "y")]


def test_null_start_in_best_hour_drops_the_day(spark):
    df = hist(spark, [(5, 9, None, "n"), (5, 3, ts(3), "ok"), (6, 1, ts(1), "other")])
    assert latest_all_forms(df) == [(2024, 1, 6, 1, "other")]


def test_null_start_next_to_a_started_run_in_same_hour(spark):
    df = hist(spark, [(5, 9, None, "n"), (5, 9, ts(9, 1), "s")])
    assert latest_all_forms(df) == [(2024, 1, 5, 9, "s")]


def test_after_day_default_and_compat(spark):
    df = spark.createDataFrame(
        [(2024, 1, 21), (2024, 2, 1), (2024, 2, 25), (2025, 1, 3), (2024, 1, 20)], "year int, month int, day int"
    )
    default = df.filter(H.after_day("year", "month", "day", ("2024", "01", "20")))
    assert rows(default) == [(2024, 1, 21), (2024, 2, 1), (2024, 2, 25), (2025, 1, 3)]
    # compat compares each part separately on strings: day 1..20 of later months are skipped
    s = df.select(
        F.col("year").cast("string").alias("year"),
        *[F.lpad(F.col(c).cast("string"), 2, "0").alias(c) for c in ("month", "day")],
    )
    compat = s.filter(H.after_day("year", "month", "day", ("2024", "01", "20"), compat=True))
    assert rows(compat) == [("2024", "01", "21"), ("2024", "02", "25")]


def test_string_hours_compare_as_strings_in_compat(spark):
    data = [
        ("SUCCESS", "Model", "FullUserInfo", "/d/year=2024/month=01/day=05/hour=9/etlid=a/", ts(9), "a"),
        ("SUCCESS", "Model", "FullUserInfo", "/d/year=2024/month=01/day=05/hour=10/etlid=b/", ts(10), "b"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(H.run_keys(H.latest_runs(H.with_path_parts(df))), "etlid") == [("b",)]
    assert rows(H.run_keys(H.latest_runs(H.with_path_parts(df, compat=True))), "etlid") == [("a",)]
