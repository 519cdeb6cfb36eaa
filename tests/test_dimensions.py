import pytest
from pyspark.sql import functions as F

from starmart.operators import dimensions as D
from starmart.operators import extractors as X
from starmart.operators.filters import allowed, not_denied
from starmart.operators.surrogate import assign_keys
from starmart.plans import facts as FT
from starmart.session import new_scratch_dir
from starmart.sources.warehouse import ParquetWarehouse
from tests.conftest import rows


def genders(spark, values):
    return spark.createDataFrame([(v, 2024, 1, 1) for v in values], "gender string, year int, month int, day int")


def test_allow_and_deny_lists_fold_case_and_drop_null(spark):
    df = spark.createDataFrame([("e",), ("C",), ("X",), (None,)], "w string")
    assert rows(df.filter(allowed("w", ["E", "C"]))) == [("C",), ("e",)]
    pt = spark.createDataFrame([("Ex-Employee",), ("EX-CONTINGENT WORKER",), ("Employee",), (None,)], "t string")
    assert rows(pt.filter(not_denied("t", ["ex-employee", "ex-contingent worker"]))) == [("Employee",)]


def test_first_merge_folds_case_and_keeps_null(spark):
    dims, sizes = D.build_dimensions(genders(spark, ["Male", "male", None, "Female", "Male"]), (D.GENDER,))
    assert rows(dims[D.GENDER.name]) == [(1, None), (2, "Female"), (3, "Male")]
    assert sizes[D.GENDER.name] == 3


def test_compat_merge_keeps_every_spelling(spark):
    dims, _ = D.build_dimensions(genders(spark, ["Male", "male", None]), (D.GENDER,), compat=True)
    assert rows(dims[D.GENDER.name], "name") == [(None,), ("Male",), ("male",)]


def test_merge_is_insert_only_with_stable_keys(spark):
    wh = ParquetWarehouse(spark, new_scratch_dir(spark, "test-wh"))
    FT.merge_dimensions(wh, genders(spark, ["b", "d"]), [D.GENDER])
    first = rows(wh.read(D.GENDER.name))
    assert first == [(1, "b"), (2, "d")]
    appended = FT.merge_dimensions(wh, genders(spark, ["A", "B", "c", "D", None]), [D.GENDER])
    assert appended[D.GENDER.name] == 3
    after = rows(wh.read(D.GENDER.name))
    assert after == [(1, "b"), (2, "d"), (3, None), (4, "A"), (5, "c")]
    again = FT.merge_dimensions(wh, genders(spark, ["A", "B", "c", "D", None]), [D.GENDER])
    assert again[D.GENDER.name] == 0 and rows(wh.read(D.GENDER.name)) == after


def test_multi_column_merge_matches_all_columns(spark):
    src = spark.createDataFrame(
        [("bu", "sl", "fn", "dp"), ("BU", "SL", "FN", "DP"), ("bu", None, "fn", "dp"), ("bu", "sl", "fn", "other")],
        "org_business_unit string, org_service_line string, org_function string, org_department string",
    )
    dims, _ = D.build_dimensions(src, (D.INFORMAL_ORG,))
    # the two spellings of one member fold to the smallest spelling of each column;
    # keys follow the natural key, nulls first
    assert rows(dims[D.INFORMAL_ORG.name]) == [
        (1, "BU", "SL", "FN", "DP"),
        (2, "bu", None, "fn", "dp"),
        (3, "bu", "sl", "fn", "other"),
    ]


def test_folding_keeps_one_row_of_the_member(spark):
    src = spark.createDataFrame([("BU", "sl"), ("bu", "SL")], "business_group string, operating_unit string")
    dims, _ = D.build_dimensions(src, (D.FORMAL_ORG,))
    assert rows(dims[D.FORMAL_ORG.name]) == [(1, "BU", "sl")]  # not BU with SL, which no row holds


def test_keys_stay_unique_when_a_large_dimension_grows(spark):
    """Merge 300,000 members, then 600,000, alone and next to another dimension."""
    email = D.DimensionSpec("EmailDim", "EmailKey", ("email",), X.Extractor(("email",), (lambda: F.col("email"),)))
    for specs in ([email], [email, D.GENDER]):
        wh = ParquetWarehouse(spark, new_scratch_dir(spark, "test-large"))
        for n in (300_000, 600_000):
            cols = [F.sha1(F.col("id").cast("string")).alias("email"), (F.col("id") % 9).cast("string").alias("gender")]
            src = spark.range(0, n, 1, 8).select(*cols, *[F.lit(1).alias(c) for c in ("month", "day")], F.lit(2024).alias("year"))
            FT.merge_dimensions(wh, src, specs)
        got = wh.read("EmailDim").agg(F.count("EmailKey"), F.countDistinct("EmailKey"), F.min("EmailKey"), F.max("EmailKey"))
        assert tuple(got.first()) == (600_000, 600_000, 1, 600_000)
        if len(specs) > 1:
            assert rows(wh.read(D.GENDER.name)) == [(k + 1, str(k)) for k in range(9)]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_assign_keys_dense_and_independent_of_partitioning(spark, partitions):
    df = spark.range(0, 500).select(
        (F.col("id") % 3).cast("string").alias("g"),
        F.when(F.col("id") % 97 == 0, None).otherwise(F.format_string("v%05d", "id")).alias("v"),
    ).dropDuplicates(["g", "v"])
    keyed = assign_keys(df, "k", ["v"], start=10, group_cols=["g"], partitions=partitions)
    per_group = {}
    for r in keyed.collect():
        per_group.setdefault(r["g"], []).append((r["v"], r["k"]))
    for members in per_group.values():
        members.sort(key=lambda t: (t[0] is not None, t[0]))
        assert [k for _, k in members] == list(range(11, 11 + len(members)))


def test_static_tables(spark):
    ag = rows(D.age_group_table(spark))
    assert ag[0] == (0, None) and [r[1] for r in ag[1:]] == ["18-24", "25-34", "35-44", "45-54", "55+"]
    day = D.day_table(spark, "2024-02-27", "2024-03-01")
    assert rows(day, "DayKey", "day") == [(20240227, 27), (20240228, 28), (20240229, 29), (20240301, 1)]
