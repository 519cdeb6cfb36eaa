import datetime as dt

from starmart import config
from starmart.operators import dimensions as D
from starmart.operators.detail import detail_columns
from starmart.operators.rules import aggregation, apply_rules, filter_rule, keep_left, no_rule
from starmart.schemas import DETAIL_COLUMNS, PEOPLE_COLUMNS
from tests.conftest import rows
from pyspark.sql import functions as F


def test_folded_lookup_vs_case_sensitive(spark):
    people = spark.createDataFrame([("1", "Male"), ("2", "male"), ("3", None), ("4", "Other")], "id string, gender string")
    dim = spark.createDataFrame([(1, None), (2, "Male")], "GenderKey int, name string")
    folded = D.GENDER.lookup(people, dim)
    assert rows(folded, "id", "GenderKey") == [("1", 2), ("2", 2), ("3", 1)]
    exact = D.GENDER.lookup(people, dim, folded=False)
    assert rows(exact, "id", "GenderKey") == [("1", 2), ("3", 1)]


def test_person_type_lookup_drops_denied_and_null(spark):
    people = spark.createDataFrame(
        [("1", "Employee"), ("2", "Ex-Employee"), ("3", None), ("4", "employee")], "id string, user_type string"
    )
    dims, sizes = D.build_dimensions(people, (D.PERSON_TYPE,))
    assert sizes[D.PERSON_TYPE.name] == 1
    got = D.PERSON_TYPE.lookup(people, dims[D.PERSON_TYPE.name], rows=1)
    assert rows(got, "id", "PersonTypeKey") == [("1", 1), ("4", 1)]


def test_age_group_lookup_keeps_under_18_through_null_band(spark):
    people = spark.createDataFrame([("1", None), ("2", "25-34")], "id string, age_group string")
    got = D.AGE_GROUP.lookup(people, D.age_group_table(spark))
    assert rows(got, "id", "AgeGroupKey") == [("1", 0), ("2", 2)]


def test_day_lookup(spark):
    people = spark.createDataFrame([("1", 2024, 2, 29), ("2", 2023, 2, 29)], "id string, year int, month int, day int")
    got = D.DAY.lookup(people, D.day_table(spark, "2024-01-01", "2024-12-31"))
    assert rows(got, "id", "DayKey", "ExactDate") == [("1", 20240229, dt.date(2024, 2, 29))]


def _detail_frame(spark, data):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PEOPLE_COLUMNS.fields) + ", ExactDate date"
    return spark.createDataFrame(data, schema)


def _person(num, day, hierarchy, location):
    return (
        (num,), ("Name " + num,), "Employee", "M", "G1", "N1", location, None, None, None, True, "E", "A",
        "BU", "SL", "FN", "DP", "DS", "BG", "OU", f"e{num}@x", (("Boss",), ("9",)), hierarchy, day,
    )


def test_detail_columns_and_manager_email(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 16)
    frame = _detail_frame(
        spark,
        [
            _person("1", d1, [("a@x",)], [("C", ("Spain",))]),
            _person("2", d2, [("a@x",), ("b@x",)], [("C", ("Spain",))]),
            _person("3", d2, [], []),
            _person("3", d2, None, None),
        ],
    )
    out = frame.where(F.col("ExactDate") == F.lit(d2)).select(*detail_columns())
    assert tuple(out.columns) == DETAIL_COLUMNS
    got = rows(out, "EmployeeNumber", "ManagerEmail", "Location", "Country", "ManagerName", "ManagerNumber")
    assert got == [("2", "b@x", "C", "Spain", "Boss", "9"), ("3", None, None, None, "Boss", "9"), ("3", None, None, None, "Boss", "9")]


def test_two_spellings_match_each_person_once(spark):
    people = spark.createDataFrame([("1", "Male"), ("2", "male")], "id string, gender string")
    dim = spark.createDataFrame([(3, "male"), (2, "Male"), (4, None)], "GenderKey int, name string")
    assert rows(D.GENDER.lookup(people, dim), "id", "GenderKey") == [("1", 2), ("2", 2)]


def test_counts_never_exceed_the_filtered_people(spark, sf):
    from starmart import fixtures
    from starmart.operators.filters import fact_filters
    from starmart.plans import catalog

    people = apply_rules(fixtures.people(spark, sf), fact_filters()).count()
    counted = catalog.fact1_after_compat_merge(spark, sf).agg(F.sum("EmployeeCount")).first()[0]
    assert 0 < counted <= people


def test_apply_rules(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("b", False), ("b", None)], "g string, ok boolean")
    out = apply_rules(df, [filter_rule(F.col("ok")), no_rule, aggregation(["g"], F.count(F.lit(1)).alias("n"))])
    assert rows(out) == [("a", 2)]
    assert keep_left(df, out) is df
    assert config.WORKER_TYPES == ("E", "C")


def test_broadcast_only_under_the_bound(spark):
    from starmart.operators.lookups import broadcast_checked

    big = spark.range(50).withColumnRenamed("id", "k")
    small_plan = spark.range(100).join(broadcast_checked(big, max_rows=100, rows=50), F.col("id") == F.col("k"))
    big_plan = spark.range(100).join(broadcast_checked(big, max_rows=10, rows=50), F.col("id") == F.col("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in small_plan._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in big_plan._jdf.queryExecution().executedPlan().toString()
        assert big_plan.count() == small_plan.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batched_lookups_equal_chained_lookups(spark):
    from starmart.operators.lookups import lookup_many

    people = spark.createDataFrame(
        [("1", "Male", "G1"), ("2", "male", None), ("3", None, "g1"), ("4", "X", "G1")], "id string, gender string, grade string"
    )
    dims, sizes = D.build_dimensions(people.withColumnRenamed("id", "_id"), (D.GENDER, D.GRADE))
    chained = D.GRADE.lookup(D.GENDER.lookup(people, dims[D.GENDER.name]), dims[D.GRADE.name])
    batched = lookup_many(people, [D.GENDER.lookup_step(dims[D.GENDER.name]), D.GRADE.lookup_step(dims[D.GRADE.name])])
    assert rows(batched) == rows(chained.select(*batched.columns))
