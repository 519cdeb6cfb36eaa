import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.functions import age, age_band, on_day, parse_watermark, path_part
from starmart.functions.keys import null_safe_match
from starmart.functions.nested import first_location_code, first_location_country, last_manager_email
from starmart.schemas import PEOPLE_COLUMNS

AS_OF = dt.date(2024, 6, 30)


def _dob_for(years: int) -> dt.date:
    # 365-day years, as the measure defines them
    return AS_OF - dt.timedelta(days=365 * years)


@pytest.mark.parametrize(
    "years,band",
    [(17, None), (18, "18-24"), (24, "18-24"), (25, "25-34"), (34, "25-34"), (35, "35-44"),
     (44, "35-44"), (45, "45-54"), (54, "45-54"), (55, "55+"), (80, "55+")],
)
def test_age_band_edges(spark, years, band):
    df = spark.createDataFrame([(_dob_for(years),)], "dob date")
    got = df.select(age_band(age("dob", AS_OF)).alias("b")).first()["b"]
    assert got == band


def test_age_band_null_and_future(spark):
    df = spark.createDataFrame([(None,), (dt.date(2030, 1, 1),)], "dob date")
    got = [r["b"] for r in df.select(age_band(age("dob", AS_OF)).alias("b")).collect()]
    assert got == [None, None]


def test_age_counts_365_day_years(spark):
    # born 1999-07-01 is 25 on 2024-06-30 (9131 days / 365 = 25.01)
    df = spark.createDataFrame([(dt.date(1999, 7, 1),)], "dob date")
    r = df.select(age("dob", AS_OF).alias("a"), age_band(age("dob", AS_OF)).alias("b")).first()
    assert int(r["a"]) == 25 and r["b"] == "25-34"


def test_on_day(spark):
    df = spark.createDataFrame(
        [(AS_OF,), (AS_OF - dt.timedelta(days=1),), (AS_OF + dt.timedelta(days=1),), (None,)], "d date"
    )
    assert [r["f"] for r in df.select(on_day("d", AS_OF).alias("f")).collect()] == [1, 0, 0, 0]


PATHS = [
    ("/x/year=2024/month=01/day=05/hour=07/etlid=g/", 2024, 1, 5, 7, "2024", "01", "05", "07"),
    ("/x/year=2024/month=1/day=5/etlid=g/hour=7", 2024, 1, 5, 7, "2024", "1", "5", ""),
    ("/x/year=2024/month=1/day=5/etlid=g/hour=12", 2024, 1, 5, 12, "2024", "1", "5", "1"),
    ("/x/year=2024/month=1/day=5/etlid=g/", 2024, 1, 5, None, "2024", "1", "5", ""),
]


@pytest.mark.parametrize("path,y,m,d,h,cy,cm,cd,ch", PATHS)
def test_path_parts(spark, path, y, m, d, h, cy, cm, cd, ch):
    df = spark.createDataFrame([(path,)], "p string")
    r = df.select(
        *[path_part("p", k).alias(k) for k in ("year", "month", "day", "hour")],
        *[path_part("p", k, compat=True).alias("c" + k) for k in ("year", "month", "day", "hour")],
    ).first()
    assert (r["year"], r["month"], r["day"], r["hour"]) == (y, m, d, h)
    assert (r["cyear"], r["cmonth"], r["cday"], r["chour"]) == (cy, cm, cd, ch)


def test_parse_watermark():
    for compat in (False, True):
        assert parse_watermark("/a/year=2024/month=01/day=20/hour=03/", compat) == ("2024", "01", "20")
    # a path that ends at the day: the whole day, or what the compatibility pattern makes of it
    assert parse_watermark("/a/year=2024/month=01/day=15") == ("2024", "01", "15")
    assert parse_watermark("/a/year=2024/month=01/day=5") == ("2024", "01", "5")
    assert parse_watermark("/a/year=2024/month=01/day=15", compat=True) == ("2024", "01", "1")
    with pytest.raises(ValueError):
        parse_watermark("/a/year=2024/month=01/day=5", compat=True)
    with pytest.raises(ValueError, match="partition path|no single"):
        parse_watermark("/a/year=2024/month=01/")
    with pytest.raises(ValueError):
        parse_watermark("/a/year=1/month=2/day=3/b/year=1/month=2/day=4/")


def test_null_safe_match_folds_case_and_matches_null(spark):
    left = spark.createDataFrame([("Male", None), ("x", "y")], "a string, b string")
    right = spark.createDataFrame([("MALE", None)], "c string, d string")
    cond = null_safe_match([left.a, left.b], [right.c, right.d])
    assert left.join(right, cond).count() == 1
    exact = null_safe_match([left.a, left.b], [right.c, right.d], folded=False)
    assert left.join(right, exact).count() == 0


def test_nested_access_is_safe_on_empty_and_null(spark):
    loc = PEOPLE_COLUMNS["work_location"].dataType
    mh = PEOPLE_COLUMNS["managers_hierarchy"].dataType
    schema = f"work_location {loc.simpleString()}, managers_hierarchy {mh.simpleString()}"
    df = spark.createDataFrame(
        [
            ([("C1", ("Spain",))], [("a@x",), ("b@x",)]),
            ([], []),
            (None, None),
        ],
        schema,
    )
    got = df.select(
        first_location_code().alias("code"), first_location_country().alias("country"), last_manager_email().alias("m")
    ).collect()
    assert [tuple(r) for r in got] == [("C1", "Spain", "b@x"), (None, None, None), (None, None, None)]


def test_expressions_stay_in_codegen(spark):
    df = spark.createDataFrame([(dt.date(1990, 1, 1),)], "dob date")
    plan = df.select(age_band(age("dob", AS_OF)), on_day("dob", AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
