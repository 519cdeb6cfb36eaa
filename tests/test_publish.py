"""Publishing end to end on the supplied sf0.001 tables."""

from pyspark.sql import functions as F

from starmart import config, fixtures
from starmart.operators import dimensions as D
from starmart.plans import catalog as C
from starmart.plans import facts as FT
from starmart.session import new_scratch_dir
from starmart.sources.snapshots import load_snapshots
from starmart.sources.warehouse import ParquetWarehouse
from tests.conftest import rows


def _tables(wh):
    names = [d.name for d in D.REGULAR] + [D.AGE_GROUP.name, D.DAY.name, config.EMPLOYEE_DETAIL,
                                            config.FACT_HEADCOUNT, config.FACT_ORGANIZATION]
    return {n: rows(wh.read(n)) for n in names}


def test_publish_twice_is_idempotent(spark, sf):
    wh = ParquetWarehouse(spark, new_scratch_dir(spark, "test-publish"))
    src = C._loaded(spark, sf)
    counts = FT.publish(wh, src, C.AS_OF)
    first = _tables(wh)
    assert counts[config.FACT_HEADCOUNT] == len(first[config.FACT_HEADCOUNT]) > 0
    FT.publish(wh, C._loaded(spark, sf), C.AS_OF)
    assert _tables(wh) == first  # same members, same keys, facts replaced not doubled


def test_fact_invariants(spark, sf):
    people = fixtures.people(spark, sf)
    dims, sizes = C._dims(people, sf)
    spec = FT.headcount_fact(C.AS_OF)
    looked = FT.lookup_frame(spec, people, dims, sizes=sizes)
    fact = FT.fact_frame(spec, people, dims, sizes=sizes)
    totals = fact.agg(F.sum("EmployeeCount"), F.sum("NewHireCount"), F.sum("SeparationCount")).first()
    assert totals[0] == looked.count()
    bad = fact.filter(
        (F.col("NewHireCount") < 0) | (F.col("SeparationCount") < 0)
        | (F.col("NewHireCount") > F.col("EmployeeCount")) | (F.col("SeparationCount") > F.col("EmployeeCount"))
    )
    assert bad.count() == 0
    # one member per folded natural key, unique keys
    for spec_d in D.REGULAR:
        t = dims[spec_d.name]
        assert t.select(spec_d.key).distinct().count() == t.count()
        assert t.select(*[F.lower(a) for a in spec_d.attrs]).distinct().count() == t.count()


def test_incremental_load_matches_full_load_after_watermark(spark, sf):
    root = fixtures.people_snapshot_tree(spark, sf)
    history = fixtures.people_runs(spark, sf)
    full = load_snapshots(spark, root, history)
    since = load_snapshots(spark, root, history, since=C.WATERMARK_PATH)
    expected = full.filter(
        (F.col("year") > 1998) | ((F.col("year") == 1998) & (F.col("month") > 3))
        | ((F.col("year") == 1998) & (F.col("month") == 3) & (F.col("day") > 1))
    )
    key = ["year", "month", "day", "hour", "etlid"]
    assert rows(since.select(F.col("id.employee_number").alias("e"), *key)) == rows(
        expected.select(F.col("id.employee_number").alias("e"), *key)
    )
    # only the later days' folders are listed
    listed = {f.split("/people/")[1].split("/hour=")[0] for f in since.inputFiles() if "/people/" in f}
    assert listed and all((int(p.split("year=")[1][:4]), int(p.split("month=")[1].split("/")[0]), int(p.split("day=")[1])) > (1998, 3, 1) for p in listed)


def test_detail_kept_when_increment_is_empty(spark, sf):
    out = C.detail_overwrite(spark, sf)
    assert out.count() > 0


def test_csv_roundtrip_matches(spark, sf):
    assert rows(C.csv_roundtrip(spark, sf)) == rows(C.fact1_headcount(spark, sf))


def test_history_read_from_a_warehouse_table(spark, sf):
    from starmart.sources import read_run_history

    wh = ParquetWarehouse(spark, new_scratch_dir(spark, "test-history"))
    wh.write(fixtures.people_runs(spark, sf), config.HISTORY_TABLE, mode="overwrite")
    history = read_run_history(wh)
    root = fixtures.people_snapshot_tree(spark, sf)
    from_table = load_snapshots(spark, root, history).select(F.col("id.employee_number").alias("e"), "etlid")
    derived = load_snapshots(spark, root, fixtures.people_runs(spark, sf)).select(
        F.col("id.employee_number").alias("e"), "etlid"
    )
    assert rows(from_table) == rows(derived)
    plan = history.filter(F.col("status") == "SUCCESS")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,SUCCESS)]" in plan


def test_incremental_publish_equals_full_publish(spark, sf):
    from starmart.operators.history import after_day

    root = fixtures.people_snapshot_tree(spark, sf)
    history = fixtures.people_runs(spark, sf)
    full = load_snapshots(spark, root, history)
    before = full.filter(~after_day("year", "month", "day", ("1998", "03", "01")))
    after = load_snapshots(spark, root, history, since=C.WATERMARK_PATH)

    step = ParquetWarehouse(spark, new_scratch_dir(spark, "test-step"))
    FT.publish(step, before, C.AS_OF)
    FT.publish(step, after, C.AS_OF)
    once = ParquetWarehouse(spark, new_scratch_dir(spark, "test-once"))
    FT.publish(once, full, C.AS_OF)

    def per_day(wh, fact, measure):
        return rows(wh.read(fact).groupBy("DayKey").agg(F.sum(measure).alias("m")))

    for fact, measure in ((config.FACT_HEADCOUNT, "EmployeeCount"), (config.FACT_HEADCOUNT, "NewHireCount"),
                          (config.FACT_ORGANIZATION, "OrganizationCount")):
        assert per_day(step, fact, measure) == per_day(once, fact, measure)
    assert rows(step.read(config.EMPLOYEE_DETAIL)) == rows(once.read(config.EMPLOYEE_DETAIL))
    # members are the same; only the order of key assignment may differ
    for d in D.REGULAR:
        assert rows(step.read(d.name).drop(d.key)) == rows(once.read(d.name).drop(d.key))
