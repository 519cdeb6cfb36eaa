"""The landing tree: what is shuffled to write it, and its rows."""

import datetime as dt

from starmart import config, fixtures
from starmart.session import new_scratch_dir


def small_tables(spark):
    root = new_scratch_dir(spark, "test-landing")
    made = {
        "region": [(1, "ASIA")],
        "nation": [(7, "JAPAN", 1)],
        "customer": [(1, "One", 7, 0.0, "BUILDING"), (2, "Two", 7, 0.0, None), (2, "Twice", 7, 0.0, None)],
        "orders": [(10, 1, "F", 0.0, dt.datetime(1995, 3, 2), "1"), (11, 2, None, 0.0, dt.datetime(1995, 3, 20), None), (12, 9, "F", 0.0, dt.datetime(1995, 3, 2), "1")],
    }
    for name, made_rows in made.items():
        spark.createDataFrame(made_rows, fixtures.SUPPLIED[name]).write.parquet(f"{root}/{name}.parquet")
    return root


def test_sources_are_dealt_in_place_of_employees(spark):
    plan = fixtures.snapshot_rows(spark, small_tables(spark))._jdf.queryExecution().optimizedPlan()
    assert plan.outputOrdering().size() == len(config.PARTITION_KEYS)  # the writer need not sort the wide rows
    lines = plan.toString().splitlines()
    dealt = next(i for i, line in enumerate(lines) if "RebalancePartitions" in line)
    assert any("AS managers_hierarchy" in line for line in lines[:dealt])
    assert not any("AS managers_hierarchy" in line for line in lines[dealt:])


def test_every_run_holds_all_people_of_its_day(spark):
    sf = small_tables(spark)
    found = fixtures.snapshot_rows(spark, sf).selectExpr("id.employee_number", "employee_name.full_name", *config.PARTITION_KEYS).collect()
    want = [("10", "One", 1), ("11", "Two", 16), ("11", "Twice", 16)]
    assert sorted(map(tuple, found)) == sorted((e, n, 1995, 3, d, h, f"p199503{d:02d}{t}") for e, n, d in want for h, t in ((6, "a"), (18, "b")))
    people = fixtures.people(spark, sf).selectExpr("id.employee_number", "employee_name.full_name", "day").collect()
    assert sorted(map(tuple, people)) == sorted(want)
