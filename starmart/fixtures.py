"""Source data derived from the supplied tables.

The job publishes from HR snapshots and a run history. Neither ships with the

* people   = orders ⋈ customer ⋈ nation ⋈ region, one employee row per order.
  The snapshot day is the order date folded to a semi-monthly day (1st or 16th),
  so the snapshot tree has a bounded number of day partitions.
* people runs: two snapshot runs of the data source ``Model`` per snapshot day
  (06:00 and 18:00, every employee in both) and one ``Report`` run at 20:00.
* event runs: a richer run history from ``events`` (ties, null starts, failed
  runs, unpadded paths, hour last) for the history operators.

The modulo rules below derive attribute values (nulls, case variants); no row
is ever filtered out by them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config, storage
from .schemas import PEOPLE_COLUMNS
from .session import scratch_root
from .sources import avro

WORK_LOCATIONS = PEOPLE_COLUMNS["work_location"].dataType

# Bump when a derivation rule changes, so a stale landing tree is not reused.
FIXTURE_VERSION = 4

AS_OF_LIT = "1998-03-01"


# Declared schemas of the supplied tables this job reads (no inference job per read).
SUPPLIED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SUPPLIED[name]) if name in SUPPLIED else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a source read as fewer partitions than there are cores.

    A table stored as one Parquet row group is scanned by one task, and every
    narrow step fused behind the scan would run in that task too. Large inputs
    (many files / row groups) already scan in parallel and are left untouched.
    """
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a Spark Connect session): leave as is
        return df
    return df.repartition(want) if have < want else df


def snapshot_years(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last snapshot year (one scan of the order date column)."""
    row = table(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return row[0].year, row[1].year


def _s(c: Column) -> Column:
    return c.cast("string")


def _date_plus(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))


def snapshot_day_parts(order_date: Column) -> list[Column]:
    d = F.to_date(order_date)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.when(F.dayofmonth(d) < 16, F.lit(1)).otherwise(F.lit(16)).alias("day"),
    ]


def people_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer, nation and region: the few columns that an employee's attributes derive from, and the snapshot day."""
    orders = spread(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
        )
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Spark broadcasts the sides whose measured size allows it; customers at
    # large scale shuffle on the key, and AQE splits skewed customers.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    src = orders.join(cust, orders.o_custkey == cust.c_custkey)
    return src.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_custkey", "c_name", "c_mktsegment", "n_nationkey", "n_name", "r_name",
        *snapshot_day_parts(F.col("o_orderdate")),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees with nested attributes plus the snapshot day (year, month, day)."""
    return employees(people_sources(spark, sf_dir), config.DAY_PARTS)


def employees(src: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Employees with nested attributes, and the columns ``keys`` as they stand."""
    ok, ck, nk = F.col("o_orderkey"), F.col("c_custkey"), F.col("n_nationkey")
    country = F.when(ok % 13 == 0, F.lower("r_name")).otherwise(F.col("r_name"))
    location = F.struct(F.col("n_name").alias("code"), F.struct(country.alias("name")).alias("country"))
    hierarchy = F.slice(
        F.array(
            F.struct(F.lit("head@corp.example").alias("email")),
            F.struct(F.concat(F.lit("lead."), F.lower("r_name"), F.lit("@corp.example")).alias("email")),
            F.struct(F.concat(F.lit("mgr."), _s(nk), F.lit("@corp.example")).alias("email")),
        ),
        1,
        (ck % 4).cast("int"),
    )
    user_type = (
        F.when(ok % 53 == 0, F.lit(None).cast("string"))
        .when(F.col("o_orderstatus") == "F", F.lit("Employee"))
        .when(F.col("o_orderstatus") == "O", F.lit("Contingent Worker"))
        .when((F.col("o_orderstatus") == "P") & (ok % 2 == 0), F.lit("Ex-Employee"))
        .when(F.col("o_orderstatus") == "P", F.lit("EX-CONTINGENT WORKER"))
    )
    return src.select(
        F.struct(_s(ok).alias("employee_number")).alias("id"),
        F.struct(F.col("c_name").alias("full_name")).alias("employee_name"),
        user_type.alias("user_type"),
        F.when(ok % 11 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("gender"),
        F.col("o_orderpriority").alias("grade"),
        F.when(ck % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("nationality"),
        F.when(ck % 43 == 0, F.lit(None))
        .when(ck % 37 == 0, F.array().cast(WORK_LOCATIONS))
        .otherwise(F.array(location))
        .alias("work_location"),
        F.when(ck % 29 == 0, F.lit(None).cast("date"))
        .otherwise(_date_plus("1930-01-01", (ck * 7919) % 25000))
        .alias("date_of_birth"),
        _date_plus(AS_OF_LIT, ok % 61 - 30).alias("hire_date"),
        F.when(ok % 5 == 0, F.lit(None).cast("date")).otherwise(_date_plus(AS_OF_LIT, ok % 47 - 15)).alias("end_date"),
        F.when(ok % 97 == 0, F.lit(None).cast("boolean")).otherwise(ok % 7 != 0).alias("is_active"),
        F.element_at(F.array(F.lit("E"), F.lit("c"), F.lit("X")), (ok % 3 + 1).cast("int")).alias("worker_type"),
        F.element_at(
            F.array(F.lit("a"), F.lit("B"), F.lit("Z"), F.lit(None).cast("string")), (ok % 4 + 1).cast("int")
        ).alias("assignment_status"),
        F.concat(F.lit("BU"), _s(ck % 2)).alias("org_business_unit"),
        F.when(ck % 13 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("SL"), _s(ck % 3))).alias(
            "org_service_line"
        ),
        F.concat(F.lit("FN"), _s(nk % 4)).alias("org_function"),
        F.when(ok % 17 == 0, F.lower("r_name")).otherwise(F.col("r_name")).alias("org_department"),
        F.concat(F.lit("DS"), _s(ok % 5)).alias("org_discipline"),
        F.col("r_name").alias("business_group"),
        F.when(nk % 5 == 4, F.lit(None).cast("string")).otherwise(F.concat(F.lit("OU"), _s(nk % 5))).alias(
            "operating_unit"
        ),
        F.concat(F.lit("emp"), _s(ok), F.lit("@corp.example")).alias("email"),
        F.struct(
            F.struct(F.concat(F.lit("Manager "), F.col("n_name")).alias("full_name")).alias("name"),
            F.struct(_s(nk).alias("employee_number")).alias("id"),
        ).alias("managers"),
        F.when(ck % 19 == 0, F.lit(None)).otherwise(hierarchy).alias("managers_hierarchy"),
        *keys,
    )


# ---------------------------------------------------------------------------
# Run histories
# ---------------------------------------------------------------------------

def _path(prefix: str, y: Column, m: Column, d: Column, h: Column, guid: Column) -> Column:
    return F.concat(
        F.lit(prefix),
        F.lit("year="), _s(y),
        F.lit("/month="), F.lpad(_s(m), 2, "0"),
        F.lit("/day="), F.lpad(_s(d), 2, "0"),
        F.lit("/hour="), F.lpad(_s(h), 2, "0"),
        F.lit("/etlid="), guid, F.lit("/"),
    )


def people_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history of the people snapshots: three runs per snapshot day."""
    days = table(spark, sf_dir, "orders").select(*snapshot_day_parts(F.col("o_orderdate"))).distinct()
    runs = F.array(
        F.struct(F.lit("a").alias("tag"), F.lit(6).alias("hour"), F.lit(config.MODEL_DATA_SOURCE).alias("ds")),
        F.struct(F.lit("b").alias("tag"), F.lit(18).alias("hour"), F.lit(config.MODEL_DATA_SOURCE).alias("ds")),
        F.struct(F.lit("c").alias("tag"), F.lit(20).alias("hour"), F.lit(config.REPORT_DATA_SOURCE).alias("ds")),
    )
    r = days.select("*", F.explode(runs).alias("r"))
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    tag, hour = F.col("r.tag"), F.col("r.hour")
    guid = F.concat(F.lit("p"), _s(y), F.lpad(_s(m), 2, "0"), F.lpad(_s(d), 2, "0"), tag)
    start = F.make_timestamp_ntz(y, m, d, hour, F.lit(5), F.lit(0))
    return r.select(
        F.when((tag == "b") & (m % 4 == 0) & (d == 1), F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.col("r.ds").alias("datasource_name"),
        F.lit(config.FULL_USER_INFO_ETL).alias("etl_name"),
        _path("/landing/people/", y, m, d, hour, guid).alias("data_path"),
        F.when((tag == "b") & (m == 7) & (d == 16), F.lit(None).cast("timestamp_ntz")).otherwise(start).alias("start"),
        guid.alias("run_guid"),
    )


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history from events: one run per (day, 6-hour slot, user batch)."""
    ev = spread(table(spark, sf_dir, "events")).select(
        "event_id",
        "event_type",
        (F.col("user_id") % 4).alias("batch"),
        F.expr("ts + make_dt_interval(CAST(user_id % 3 AS INT) * 31)").alias("rts"),
    )
    ev = ev.select(
        "event_id",
        "event_type",
        "batch",
        "rts",
        F.to_date("rts").alias("run_date"),
        (F.hour("rts") - F.hour("rts") % 6).alias("slot"),
    )
    runs = ev.groupBy("run_date", "slot", "batch").agg(
        F.min("event_id").alias("first_event"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "error").alias("n_err"),
        F.min("rts").alias("first_ts"),
    )
    y, m, d = F.year("run_date"), F.month("run_date"), F.dayofmonth("run_date")
    slot, batch = F.col("slot"), F.col("batch")
    guid = F.concat(F.lit("r"), F.date_format("run_date", "yyyyMMdd"), F.lpad(_s(slot), 2, "0"), F.lit("-"), _s(batch))
    ds = F.when(batch % 2 == 0, F.lit(config.MODEL_DATA_SOURCE)).otherwise(F.lit(config.REPORT_DATA_SOURCE))
    odd_path = F.concat(  # unpadded parts, hour last, no trailing slash
        F.lit("/landing/report/year="), _s(y),
        F.lit("/month="), _s(m),
        F.lit("/day="), _s(d),
        F.lit("/etlid="), guid,
        F.lit("/hour="), _s(slot),
    )
    return runs.select(
        F.when(F.col("n_err") * 2 > F.col("n"), F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        ds.alias("datasource_name"),
        F.when(F.col("first_event") % 7 == 0, F.lit("Other")).otherwise(F.lit(config.FULL_USER_INFO_ETL)).alias("etl_name"),
        F.when(batch == 3, odd_path).otherwise(_path("/landing/events/", y, m, d, slot, guid)).alias("data_path"),
        F.when(F.col("first_event") % 10 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.date_trunc("minute", "first_ts").cast("timestamp_ntz"))
        .alias("start"),
        guid.alias("run_guid"),
    )


# ---------------------------------------------------------------------------
# Snapshot landing tree (written once per input folder, then reused)
# ---------------------------------------------------------------------------

def landing_root(spark: SparkSession, sf_dir: str) -> str:
    """A folder named after the input's path and the state of the tables the people come from."""
    sf = sf_dir.rstrip("/")
    facts = [sf] + [storage.fingerprint(spark, f"{sf}/{t}.parquet") for t in ("orders", "customer", "nation", "region")]
    tag = hashlib.sha1("|".join(facts).encode()).hexdigest()[:10]
    return f"{scratch_root(spark)}/landing-v{FIXTURE_VERSION}-{tag}"


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees of the Model snapshot runs (a, b) with the partition keys, dealt by run and in the keys' order."""
    runs = F.array(F.struct(F.lit("a").alias("tag"), F.lit(6).alias("hour")),
                   F.struct(F.lit("b").alias("tag"), F.lit(18).alias("hour")))
    src = people_sources(spark, sf_dir).select("*", F.explode(runs).alias("r"))
    src = src.select(
        *[c for c in src.columns if c != "r"],
        F.col("r.hour").alias("hour"),
        F.concat(
            F.lit("p"), _s(F.col("year")), F.lpad(_s(F.col("month")), 2, "0"),
            F.lpad(_s(F.col("day")), 2, "0"), F.col("r.tag"),
        ).alias("etlid"),
    )
    # One run is one day's whole snapshot; the rebalance splits runs of any size
    # into tasks of the advised size and joins small ones. What the employees derive
    # from is dealt and sorted, not the employees, which are many times as wide; the
    # order lasts through the derivation, so the writer doesn't sort again.
    dealt = src.hint("rebalance", *config.PARTITION_KEYS).sortWithinPartitions(*config.PARTITION_KEYS)
    return employees(dealt, config.PARTITION_KEYS)


def people_snapshot_tree(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> str:
    """Write the Model snapshot runs (a, b) as year/month/day/hour/etlid Parquet or Avro."""
    root = landing_root(spark, sf_dir) + ("/people" if fmt == "parquet" else f"/people-{fmt}")
    if storage.exists(spark, f"{root}.complete/_SUCCESS"):
        return root
    p = snapshot_rows(spark, sf_dir)
    if fmt == "avro":
        storage.remove(spark, root)  # of a run that died
        writer = p.write.format(avro.register(spark))
        writer.option("partitionBy", ",".join(config.PARTITION_KEYS)).mode("append").save(root)
    else:
        p.write.mode("overwrite").partitionBy(*config.PARTITION_KEYS).parquet(root)
    spark.range(1).write.mode("overwrite").parquet(f"{root}.complete")
    return root
