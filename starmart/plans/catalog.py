"""The query catalogue: one Spark query per operator, each with DuckDB SQL.

Every query reads the supplied tables (or data Spark derives from them) in
full. Queries that exercise the warehouse write to a fresh folder under the
shared scratch root and return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config, fixtures
from ..functions.nested import first_location_country, last_manager_email
from ..functions.people import age, age_band, on_day
from ..operators import dimensions as D
from ..operators import extractors as X
from ..operators import history as H
from ..operators.filters import allowed, is_active, not_denied_person_type
from ..operators.rules import aggregation, apply_rules, filter_rule, no_rule
from ..schemas import PEOPLE_SNAPSHOT
from ..session import new_scratch_dir
from ..sources.snapshots import load_snapshots
from ..sources.warehouse import CsvWarehouse, ParquetWarehouse
from . import facts as FT
from . import oracle as O

AS_OF = config.QUERY_AS_OF
# The incremental queries resume after this path (1 March 1998, evening run).
WATERMARK_PATH = "/landing/people/year=1998/month=03/day=01/hour=18/etlid=p19980301b/"
WATERMARK = ("1998", "03", "01")
# A watermark whose path ends at the day, without a slash.
DAY_LAST_PATH = "/landing/people/year=1998/month=03/day=16"
DAY_LAST = ("1998", "03", "16")
# First batch of the two-step merges: snapshots before 1996.
FIRST_YEAR = 1996
FIRST_BATCH_SQL = "year < 1996"

Query = Callable[[SparkSession, str], DataFrame]


def _emp() -> F.Column:
    return F.col("id.employee_number").alias("employee_number")


def _people(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.people(spark, sf)


def _derived(spark: SparkSession, sf: str) -> DataFrame:
    return apply_rules(_people(spark, sf), FT.derivations(AS_OF))


def _dims(
    people: DataFrame, sf: str, needed: tuple[D.DimensionSpec, ...] | None = None
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Dimensions as a first publish builds them from ``people``, with row counts.

    Keys are numbered per dimension, so building only the ``needed`` regular
    dimensions gives the same keys as building all of them.
    """
    regular = tuple(d for d in (needed or D.REGULAR) if not d.static)
    dims, sizes = D.build_dimensions(people, regular) if regular else ({}, {})
    spark = people.sparkSession
    dims[D.AGE_GROUP.name] = D.age_group_table(spark)
    sizes[D.AGE_GROUP.name] = len(config.AGE_BANDS) + 1
    first, last = fixtures.snapshot_years(spark, sf)
    dims[D.DAY.name] = D.day_table(spark, f"{first:04d}-01-01", f"{last:04d}-12-31")
    sizes[D.DAY.name] = (dt.date(last, 12, 31) - dt.date(first, 1, 1)).days + 1
    return dims, sizes


def _event_history(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.event_runs(spark, sf)


def _model_runs(spark: SparkSession, sf: str, compat: bool = False) -> DataFrame:
    return H.with_path_parts(H.successful_runs(_event_history(spark, sf)), compat)


def _warehouse(spark: SparkSession) -> ParquetWarehouse:
    return ParquetWarehouse(spark, new_scratch_dir(spark, "warehouse"))


def _loaded(spark: SparkSession, sf: str, since: str | None = None, compat: bool = False, fmt: str = "parquet", schema: T.StructType = PEOPLE_SNAPSHOT) -> DataFrame:
    root = fixtures.people_snapshot_tree(spark, sf, fmt)
    return load_snapshots(spark, root, fixtures.people_runs(spark, sf), since=since, schema=schema, fmt=fmt, compat=compat)


def _avro_schema(*columns: str) -> T.StructType:
    """What a query declares of an Avro tree: Spark asks a Python source for every declared column, used or not."""
    return T.StructType([f for f in PEOPLE_SNAPSHOT.fields if f.name in (*columns, *config.PARTITION_KEYS)])


# ---------------------------------------------------------------------------
# History
# ---------------------------------------------------------------------------

def history_success(spark, sf):
    return H.successful_runs(_event_history(spark, sf))


def history_path_parts(spark, sf, compat=False):
    h = H.with_path_parts(_event_history(spark, sf), compat)
    return h.select("run_guid", "data_path", "year", "month", "day", "hour")


def history_path_parts_compat(spark, sf):
    return history_path_parts(spark, sf, compat=True)


def history_latest_run(spark, sf):
    best = H.latest_runs(_model_runs(spark, sf))
    return best.select(*H.RUN_PARTS, F.col("run_guid").alias("etlid"), "start")


def history_latest_run_ranked(spark, sf):
    best = H.latest_runs_ranked(_model_runs(spark, sf))
    return best.select(*H.RUN_PARTS, F.col("run_guid").alias("etlid"), "start")


def history_latest_run_compat(spark, sf):
    best = H.latest_runs(_model_runs(spark, sf, compat=True))
    return best.select(*H.RUN_PARTS, F.col("run_guid").alias("etlid"), "start")


def win_first_value(spark, sf):
    w = H.day_first_values(_model_runs(spark, sf))
    return w.select("run_guid", *H.RUN_PARTS, "start", "last_hour", "last_start")


# ---------------------------------------------------------------------------
# Loading
# ---------------------------------------------------------------------------

def _load_cols(df: DataFrame) -> DataFrame:
    return df.select(_emp(), *config.PARTITION_KEYS)


def load_all(spark, sf):
    return _load_cols(_loaded(spark, sf))


def load_all_avro(spark, sf):
    """The full load from an Avro tree."""
    return _load_cols(_loaded(spark, sf, fmt="avro", schema=_avro_schema("id")))


def load_missing_avro(spark, sf):
    """People of the days after the watermark from an Avro tree, with nested fields and dates."""
    read = _avro_schema("id", "gender", "date_of_birth", "is_active", "work_location", "managers_hierarchy")
    p = _loaded(spark, sf, since=WATERMARK_PATH, fmt="avro", schema=read)
    return p.select(_emp(), "gender", "date_of_birth", "is_active", first_location_country().alias("location_country"), last_manager_email().alias("manager_email"), *config.PARTITION_KEYS)


def load_missing(spark, sf):
    return _load_cols(_loaded(spark, sf, since=WATERMARK_PATH))


def load_missing_day_last(spark, sf):
    return _load_cols(_loaded(spark, sf, since=DAY_LAST_PATH))


def load_missing_compat(spark, sf):
    return _load_cols(_loaded(spark, sf, since=WATERMARK_PATH, compat=True))


# ---------------------------------------------------------------------------
# Filters and derived columns
# ---------------------------------------------------------------------------

def filter_whitelist(spark, sf):
    rules = [
        filter_rule(allowed("assignment_status", config.ASSIGNMENT_STATUSES)),
        filter_rule(allowed("worker_type", config.WORKER_TYPES)),
    ]
    return apply_rules(_people(spark, sf), rules).select(_emp(), "worker_type", "assignment_status")


def filter_blacklist(spark, sf):
    return _people(spark, sf).filter(not_denied_person_type()).select(_emp(), "user_type")


def people_active(spark, sf):
    return _people(spark, sf).filter(is_active()).select(_emp())


def people_derived(spark, sf):
    return _derived(spark, sf).select(_emp(), "age", "age_group", "is_new_hire", "is_separation")


def people_age(spark, sf):
    p = _people(spark, sf).select(age_band(age("date_of_birth", AS_OF)).alias("age_group"))
    return p.groupBy("age_group").agg(F.count(F.lit(1)).alias("people"))


def people_new_hire(spark, sf):
    p = _people(spark, sf)
    return p.filter(on_day("hire_date", AS_OF) == 1).select(_emp(), "hire_date")


def people_separation(spark, sf):
    p = _people(spark, sf)
    return p.filter(on_day("end_date", AS_OF) == 1).select(_emp(), "end_date")


# ---------------------------------------------------------------------------
# Dimension members, static tables, merges
# ---------------------------------------------------------------------------

def _extract(spec: D.DimensionSpec) -> Query:
    return lambda spark, sf: D.member_rows(_people(spark, sf), spec)


def dim_day(spark, sf):
    return _dims_static_day(spark, sf)


def _dims_static_day(spark, sf):
    first, last = fixtures.snapshot_years(spark, sf)
    return D.day_table(spark, f"{first:04d}-01-01", f"{last:04d}-12-31")


def dim_age_group(spark, sf):
    """The static age-group table, with how many people fall into each band."""
    bands = D.age_group_table(spark)
    ages = _derived(spark, sf).select("age_group")
    looked = D.AGE_GROUP.lookup(ages, bands, rows=len(config.AGE_BANDS) + 1)
    counts = looked.groupBy("AgeGroupKey").agg(F.count(F.lit(1)).alias("people"))
    return bands.join(counts, "AgeGroupKey", "left").select(
        "AgeGroupKey", "name", F.coalesce("people", F.lit(0)).alias("people")
    )


def _two_step(spec: D.DimensionSpec, compat: bool = False) -> Query:
    def run(spark, sf):
        wh = _warehouse(spark)
        people = _people(spark, sf)
        FT.merge_dimensions(wh, people.filter(F.col("year") < FIRST_YEAR), [spec], compat)
        FT.merge_dimensions(wh, people, [spec], compat)
        return wh.read(spec.name)

    return run


def dim_merge_all(spark, sf):
    """All seven regular dimensions merged twice (first batch, then everything)."""
    wh = _warehouse(spark)
    people = _people(spark, sf)
    FT.merge_dimensions(wh, people.filter(F.col("year") < FIRST_YEAR), D.REGULAR)
    FT.merge_dimensions(wh, people, D.REGULAR)
    parts = []
    for spec in D.REGULAR:
        t = wh.read(spec.name)
        cols = [F.col(a).cast("string").alias(f"a{i}") for i, a in enumerate(spec.attrs)]
        cols += [F.lit(None).cast("string").alias(f"a{i}") for i in range(len(spec.attrs), 4)]
        parts.append(t.select(F.lit(spec.name).alias("dim"), F.col(spec.key).alias("key"), *cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Lookups
# ---------------------------------------------------------------------------

def _lookup(spec: D.DimensionSpec, folded: bool = True) -> Query:
    def run(spark, sf):
        people = _derived(spark, sf)
        dims, sizes = _dims(_people(spark, sf), sf, (spec,))
        out = spec.lookup(people, dims[spec.name], folded=folded, rows=sizes[spec.name], unique=True)
        extra = ["ExactDate"] if spec.kind == "day" else []
        return out.select(_emp(), spec.key, *extra)

    return run


# ---------------------------------------------------------------------------
# Rules, facts, detail
# ---------------------------------------------------------------------------

def agg_rule(spark, sf):
    rules = [
        filter_rule(is_active()),
        no_rule,
        aggregation(["gender"], F.count(F.lit(1)).alias("people")),
    ]
    return apply_rules(_people(spark, sf), rules)


def fact1_headcount(spark, sf):
    people = _people(spark, sf)
    dims, sizes = _dims(people, sf)
    return FT.fact_frame(FT.headcount_fact(AS_OF), people, dims, sizes=sizes, unique=dims)


def fact2_org_count(spark, sf):
    people = _people(spark, sf)
    spec = FT.organization_fact()
    dims, sizes = _dims(people, sf, spec.lookups)
    return FT.fact_frame(spec, people, dims, sizes=sizes, unique=dims)


def employee_detail_query(spark, sf):
    people = _people(spark, sf)
    dims, sizes = _dims(people, sf)
    spec = FT.headcount_fact(AS_OF)
    _, written = FT.counted(FT.fact_frame(spec, people, dims, sizes=sizes, unique=dims))
    latest = FT.latest_of(dims[D.DAY.name], written)
    return FT.detail_frame(spec, people, dims, latest, sizes=sizes, unique=dims)


def _published(spark, sf, runs: int = 1) -> ParquetWarehouse:
    wh = _warehouse(spark)
    for _ in range(runs):
        FT.publish(wh, _loaded(spark, sf), AS_OF)
    return wh


def fact1_end_to_end(spark, sf):
    wh = _warehouse(spark)
    FT.update_fact(FT.headcount_fact(AS_OF), wh, _loaded(spark, sf))
    return wh.read(config.FACT_HEADCOUNT).select(*FT.HEADCOUNT_KEYS, "EmployeeCount", "NewHireCount", "SeparationCount")


def fact2_end_to_end(spark, sf):
    wh = _published(spark, sf)
    return wh.read(config.FACT_ORGANIZATION).select(*FT.ORGANIZATION_KEYS, "OrganizationCount")


def fact_idempotent_write(spark, sf):
    wh = _published(spark, sf, runs=2)
    return wh.read(config.FACT_HEADCOUNT).select(*FT.HEADCOUNT_KEYS, "EmployeeCount", "NewHireCount", "SeparationCount")


def detail_overwrite(spark, sf):
    """Full publish, then an incremental publish with nothing new: detail is kept."""
    wh = _warehouse(spark)
    FT.publish(wh, _loaded(spark, sf), AS_OF)
    latest = _loaded(spark, sf).agg(F.max(F.make_date("year", "month", "day"))).first()[0]
    since = f"/landing/people/year={latest.year:04d}/month={latest.month:02d}/day={latest.day:02d}/"
    FT.publish(wh, _loaded(spark, sf, since=since), AS_OF)
    return wh.read(config.EMPLOYEE_DETAIL)


# A dimension of one member an employee, for merges of high cardinality.
EMAIL = D.DimensionSpec("reporting.EmailDim", "EmailKey", ("email",), X.Extractor(("email",), (lambda: F.col("email"),)))


def dim_merge_high_cardinality(spark, sf):
    """One member an employee, merged twice: the second merge appends to a large table."""
    return _two_step(EMAIL)(spark, sf)


def _preloaded(spark, sf) -> ParquetWarehouse:
    """A warehouse whose day table is there before the first publish, with keys 1..n."""
    wh = _warehouse(spark)
    days = _dims_static_day(spark, sf)
    first = days.agg(F.min("ExactDate")).first()[0]
    own = days.withColumn("DayKey", (F.datediff("ExactDate", F.lit(first)) + 1).cast("int"))
    wh.write(own, D.DAY.name)
    FT.update_fact(FT.headcount_fact(AS_OF), wh, _loaded(spark, sf))
    return wh


def fact1_preloaded_day(spark, sf):
    """The headcount with a preloaded day table; its keys are mapped to yyyymmdd for comparison."""
    wh = _preloaded(spark, sf)
    day = wh.read(D.DAY.name).select("DayKey", (F.col("year") * 10000 + F.col("month") * 100 + F.col("day")).alias("date"))
    fact = wh.read(config.FACT_HEADCOUNT).join(day, "DayKey").withColumn("DayKey", F.col("date"))
    return fact.select(*FT.HEADCOUNT_KEYS, "EmployeeCount", "NewHireCount", "SeparationCount")


def detail_preloaded_day(spark, sf):
    return _preloaded(spark, sf).read(config.EMPLOYEE_DETAIL)


def fact1_after_compat_merge(spark, sf):
    """Dimensions merged with every spelling, then the default lookups: each person counts once."""
    wh = _warehouse(spark)
    people = _people(spark, sf)
    FT.merge_dimensions(wh, people, D.REGULAR, compat=True)
    dims = _dims(people, sf, (D.AGE_GROUP, D.DAY))[0] | {d.name: wh.read(d.name, d.table_schema()) for d in D.REGULAR}
    return FT.fact_frame(FT.headcount_fact(AS_OF), people, dims)


# The day whose people all become inactive before the second run of fact_rerun_empty_day.
EMPTY_DAY = dt.date(1995, 6, 16)


def fact_rerun_empty_day(spark, sf):
    """Two runs; in the second, nobody is active on one day, whose fact rows must go."""
    wh = _warehouse(spark)
    spec = FT.headcount_fact(AS_OF)
    FT.update_fact(spec, wh, _loaded(spark, sf))
    source = _loaded(spark, sf)
    gone = FT.snapshot_day() == F.lit(EMPTY_DAY)
    FT.update_fact(spec, wh, source.withColumn("is_active", F.when(gone, F.lit(False)).otherwise(F.col("is_active"))))
    return wh.read(config.FACT_HEADCOUNT).select(*FT.HEADCOUNT_KEYS, "EmployeeCount", "NewHireCount", "SeparationCount")


class _Dies(ParquetWarehouse):
    """A warehouse whose process ends when it has stored the fact and is about to replace the detail."""

    def write(self, df, name, *args, **kwargs):
        if name == config.EMPLOYEE_DETAIL:
            raise KeyboardInterrupt(f"lost before writing {name}")
        super().write(df, name, *args, **kwargs)


def fact_crash_recovery(spark, sf):
    """A refresh, then one on other data that dies half-way: the fact is still that of the first."""
    wh = _warehouse(spark)
    spec = FT.headcount_fact(AS_OF)
    FT.update_fact(spec, wh, _loaded(spark, sf))
    try:
        FT.update_fact(spec, _Dies(spark, wh.root), _loaded(spark, sf).withColumn("is_active", F.col("month") % 2 == 0))
    except KeyboardInterrupt:
        pass
    return wh.read(config.FACT_HEADCOUNT).select(*FT.HEADCOUNT_KEYS, "EmployeeCount", "NewHireCount", "SeparationCount")


def dim_merge_concurrent(spark, sf):
    """Two publishers merge overlapping halves of the people at the same time: members, and whether keys are 1 to n."""
    root = new_scratch_dir(spark, "warehouse")
    people = _people(spark, sf)
    halves = [people.where(F.col("year") < FIRST_YEAR + 1), people.where(F.col("year") >= FIRST_YEAR - 1)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda half: FT.merge_dimensions(ParquetWarehouse(spark, root), half, [EMAIL, D.INFORMAL_ORG]), halves))
    wh = ParquetWarehouse(spark, root)
    parts = []
    for spec in (EMAIL, D.INFORMAL_ORG):
        t = wh.read(spec.name)
        folded = F.struct(*[F.coalesce(F.concat(F.lit("v"), F.lower(a)), F.lit("-")) for a in spec.attrs])
        parts.append(
            t.agg(F.count_distinct(spec.key).alias("keys"), F.min(spec.key).alias("first"), F.max(spec.key).alias("last"), F.count_distinct(folded).alias("members"))
            .select(F.lit(spec.name).alias("dim"), "keys", "first", "last", "members")
        )
    return parts[0].unionByName(parts[1])


def publish_all(spark, sf):
    """Row counts of every table a publish writes."""
    wh = _published(spark, sf)
    names = [d.name for d in D.REGULAR] + [
        D.AGE_GROUP.name,
        D.DAY.name,
        config.EMPLOYEE_DETAIL,
        config.FACT_HEADCOUNT,
        config.FACT_ORGANIZATION,
    ]
    parts = [wh.read(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def csv_roundtrip(spark, sf):
    wh = CsvWarehouse(spark, new_scratch_dir(spark, "csv"))
    fact = fact1_headcount(spark, sf)
    wh.write(fact, "headcount", mode="overwrite")
    return wh.read("headcount", schema=fact.schema)


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------

def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "history_success": history_success,
        "history_path_parts": history_path_parts,
        "history_path_parts_compat": history_path_parts_compat,
        "history_latest_run": history_latest_run,
        "history_latest_run_ranked": history_latest_run_ranked,
        "history_latest_run_compat": history_latest_run_compat,
        "win_first_value": win_first_value,
        "load_all": load_all,
        "load_all_avro": load_all_avro,
        "load_missing_avro": load_missing_avro,
        "load_missing": load_missing,
        "load_missing_day_last": load_missing_day_last,
        "load_missing_compat": load_missing_compat,
        "filter_whitelist": filter_whitelist,
        "filter_blacklist": filter_blacklist,
        "people_active": people_active,
        "people_derived": people_derived,
        "people_age": people_age,
        "people_new_hire": people_new_hire,
        "people_separation": people_separation,
        "dim_extract_location": _extract(D.LOCATION),
        "dim_extract_nationality": _extract(D.NATIONALITY),
        "dim_extract_gender": _extract(D.GENDER),
        "dim_extract_grade": _extract(D.GRADE),
        "dim_extract_person_type": _extract(D.PERSON_TYPE),
        "dim_extract_informal_org": _extract(D.INFORMAL_ORG),
        "dim_extract_formal_org": _extract(D.FORMAL_ORG),
        "dim_day": dim_day,
        "dim_age_group": dim_age_group,
        "dim_merge_incremental": _two_step(D.GENDER),
        "dim_merge_multi": _two_step(D.INFORMAL_ORG),
        "dim_merge_compat": _two_step(D.GENDER, compat=True),
        "dim_merge_all": dim_merge_all,
        "lookup_age_group": _lookup(D.AGE_GROUP),
        "lookup_location": _lookup(D.LOCATION),
        "lookup_person_type": _lookup(D.PERSON_TYPE),
        "lookup_gender": _lookup(D.GENDER),
        "lookup_grade": _lookup(D.GRADE),
        "lookup_nationality": _lookup(D.NATIONALITY),
        "lookup_day": _lookup(D.DAY),
        "lookup_informal_org": _lookup(D.INFORMAL_ORG),
        "lookup_formal_org": _lookup(D.FORMAL_ORG),
        "lookup_compat": _lookup(D.GENDER, folded=False),
        "agg_rule": agg_rule,
        "fact1_headcount": fact1_headcount,
        "fact2_org_count": fact2_org_count,
        "employee_detail": employee_detail_query,
        "detail_overwrite": detail_overwrite,
        "fact1_end_to_end": fact1_end_to_end,
        "fact2_end_to_end": fact2_end_to_end,
        "fact_idempotent_write": fact_idempotent_write,
        "dim_merge_high_cardinality": dim_merge_high_cardinality,
        "fact1_preloaded_day": fact1_preloaded_day,
        "detail_preloaded_day": detail_preloaded_day,
        "fact1_after_compat_merge": fact1_after_compat_merge,
        "fact_rerun_empty_day": fact_rerun_empty_day,
        "fact_crash_recovery": fact_crash_recovery,
        "dim_merge_concurrent": dim_merge_concurrent,
        "publish_all": publish_all,
        "csv_roundtrip": csv_roundtrip,
    }
    return q


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes if c.strip()) + "\n"


_EMP_COLS = "employee_number"


def _lookup_sql(dim: str | None, kind: str, folded: bool = True) -> str:
    base = _w(O.PEOPLE, O.derived("people"))
    if kind == "age_group":
        return base + f"SELECT employee_number, {O.age_group_key('age_group')} AS AgeGroupKey FROM derived"
    if kind == "day":
        return (
            base + f"SELECT employee_number, {O.day_key('derived')} AS DayKey, "
            "make_date(year, month, day) AS ExactDate FROM derived"
        )
    key = O.DIMS[dim][0]
    return (
        _w(O.PEOPLE, O.derived("people"), O.dim_ctes("people"))
        + f"SELECT p.employee_number, d_{dim}.{key} FROM derived p\n"
        + O.lookup_joins("p", [dim], folded=folded)
    )


def _extract_sql(dim: str) -> str:
    return _w(O.PEOPLE) + O.members(dim, "people", folded=False)


def _load_sql(compat: bool = False, since: tuple[str, str, str] | None = None) -> str:
    return (
        _w(O.PEOPLE, O.PEOPLE_RUNS, O.loaded_people(compat, since))
        + "SELECT employee_number, year, month, day, hour, etlid FROM loaded"
    )


def _latest_sql(compat: bool = False) -> str:
    inner = O.latest(O.path_parts(f"({O.successful('event_history')})", compat))
    return _w(O.EVENT_RUNS) + f"SELECT year, month, day, hour, run_guid AS etlid, start FROM ({inner})"


def _two_step_sql(dim: str, compat: bool = False) -> str:
    return "WITH " + O.PEOPLE.strip() + ",\n" + O.two_step_merge(dim, "people", FIRST_BATCH_SQL, compat).strip()


def _high_cardinality_sql() -> str:
    keyed = "CAST(row_number() OVER (ORDER BY email) AS INTEGER)"
    first = f"SELECT email FROM people GROUP BY email HAVING count(*) FILTER ({FIRST_BATCH_SQL}) > 0"
    return (
        _w(O.PEOPLE, f"k1 AS (SELECT {keyed} AS EmailKey, email FROM ({first}))")
        + f"SELECT * FROM k1 UNION ALL SELECT {keyed} + (SELECT count(*) FROM k1)::INTEGER, email "
        + "FROM (SELECT DISTINCT email FROM people WHERE email NOT IN (SELECT email FROM k1))"
    )


def _merge_all_sql() -> str:
    parts = []
    for dim in O.FACT1_DIMS:
        key, cols, _ = O.DIMS[dim]
        attrs = [a for a, _ in cols] + ["NULL"] * (4 - len(cols))
        sel = ", ".join(f"CAST({a} AS VARCHAR) AS a{i}" for i, a in enumerate(attrs))
        body = O.two_step_merge(dim, "people", FIRST_BATCH_SQL).strip()
        parts.append(f"SELECT '{_dim_table_name(dim)}' AS dim, {key} AS key, {sel} FROM (WITH {body})")
    return _w(O.PEOPLE) + "\nUNION ALL\n".join(parts)


def _dim_table_name(dim: str) -> str:
    return {
        "location": config.DIM_LOCATION,
        "person_type": config.DIM_PERSON_TYPE,
        "gender": config.DIM_GENDER,
        "grade": config.DIM_GRADE,
        "nationality": config.DIM_NATIONALITY,
        "informal_org": config.DIM_INFORMAL_ORG,
        "formal_org": config.DIM_FORMAL_ORG,
    }[dim]


def _publish_all_sql() -> str:
    counts = [
        f"SELECT '{_dim_table_name(dim)}' AS table_name, count(*) AS rows FROM ({O.members(dim, 'loaded')})"
        for dim in O.FACT1_DIMS
    ]
    counts.append(f"SELECT '{config.DIM_AGE_GROUP}', CAST(6 AS BIGINT)")
    counts.append(
        f"SELECT '{config.DIM_DAY}', CAST(date_diff('day', make_date(min(year), 1, 1), "
        "make_date(max(year), 12, 31)) + 1 AS BIGINT) FROM loaded"
    )
    counts.append(f"SELECT '{config.EMPLOYEE_DETAIL}', count(*) FROM (WITH {O.detail_sql('loaded').strip()})")
    counts.append(f"SELECT '{config.FACT_HEADCOUNT}', count(*) FROM (WITH {O.headcount_sql('loaded').strip()})")
    counts.append(f"SELECT '{config.FACT_ORGANIZATION}', count(*) FROM (WITH {O.organization_sql('loaded').strip()})")
    return _w(O.PEOPLE, O.PEOPLE_RUNS, O.loaded_people()) + "\nUNION ALL\n".join(counts)


def oracle_sql() -> dict[str, str]:
    loaded = _w(O.PEOPLE, O.PEOPLE_RUNS, O.loaded_people())
    fact1_e2e = loaded.rstrip() + ",\n" + O.headcount_sql("loaded").strip()
    people = _w(O.PEOPLE)
    derived = _w(O.PEOPLE, O.derived("people"))
    ev = _w(O.EVENT_RUNS)
    sql = {
        "history_success": ev + O.successful("event_history"),
        "history_path_parts": ev
        + "SELECT run_guid, data_path, year, month, day, hour FROM ("
        + O.path_parts("event_history")
        + ")",
        "history_path_parts_compat": ev
        + "SELECT run_guid, data_path, year, month, day, hour FROM ("
        + O.path_parts("event_history", compat=True)
        + ")",
        "history_latest_run": _latest_sql(),
        "history_latest_run_ranked": _latest_sql(),
        "history_latest_run_compat": _latest_sql(compat=True),
        "win_first_value": ev
        + "SELECT run_guid, year, month, day, hour, start, "
        + "first_value(hour) OVER w AS last_hour, first_value(start) OVER w AS last_start FROM ("
        + O.path_parts(f"({O.successful('event_history')})")
        + ") WINDOW w AS (PARTITION BY year, month, day ORDER BY hour DESC NULLS LAST, start DESC NULLS LAST)",
        "load_all": _load_sql(),
        "load_all_avro": _load_sql(),
        "load_missing_avro": _w(O.PEOPLE, O.PEOPLE_RUNS, O.loaded_people(False, WATERMARK))
        + "SELECT employee_number, gender, date_of_birth, is_active, location_country, "
        + "manager_email, year, month, day, hour, etlid FROM loaded",
        "load_missing": _load_sql(since=WATERMARK),
        "load_missing_day_last": _load_sql(since=DAY_LAST),
        "load_missing_compat": _load_sql(compat=True, since=WATERMARK),
        "filter_whitelist": people
        + "SELECT employee_number, worker_type, assignment_status FROM people "
        + "WHERE lower(assignment_status) IN ('a', 'b') AND lower(worker_type) IN ('e', 'c')",
        "filter_blacklist": people + f"SELECT employee_number, user_type FROM people WHERE {O.NOT_DENIED}",
        "people_active": people + "SELECT employee_number FROM people WHERE is_active",
        "people_derived": derived + "SELECT employee_number, age, age_group, is_new_hire, is_separation FROM derived",
        "people_age": derived + "SELECT age_group, count(*) AS people FROM derived GROUP BY age_group",
        "people_new_hire": people + f"SELECT employee_number, hire_date FROM people WHERE hire_date = {O.AS_OF}",
        "people_separation": people + f"SELECT employee_number, end_date FROM people WHERE end_date = {O.AS_OF}",
        "dim_extract_location": _extract_sql("location"),
        "dim_extract_nationality": _extract_sql("nationality"),
        "dim_extract_gender": _extract_sql("gender"),
        "dim_extract_grade": _extract_sql("grade"),
        "dim_extract_person_type": _extract_sql("person_type"),
        "dim_extract_informal_org": _extract_sql("informal_org"),
        "dim_extract_formal_org": _extract_sql("formal_org"),
        "dim_day": people
        + "SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS DayKey, "
        + "CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, "
        + "d AS ExactDate FROM (SELECT CAST(unnest(generate_series(make_date(min(year), 1, 1), "
        + "make_date(max(year), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM people)",
        "dim_age_group": derived
        + "SELECT b.AgeGroupKey, b.name, count(d.age_group_key) AS people FROM ("
        + "SELECT CAST(0 AS INTEGER) AS AgeGroupKey, CAST(NULL AS VARCHAR) AS name "
        + "UNION ALL SELECT 1, '18-24' UNION ALL SELECT 2, '25-34' UNION ALL SELECT 3, '35-44' "
        + "UNION ALL SELECT 4, '45-54' UNION ALL SELECT 5, '55+') b LEFT JOIN "
        + f"(SELECT {O.age_group_key('age_group')} AS age_group_key FROM derived) d "
        + "ON b.AgeGroupKey = d.age_group_key GROUP BY b.AgeGroupKey, b.name",
        "dim_merge_incremental": _two_step_sql("gender"),
        "dim_merge_multi": _two_step_sql("informal_org"),
        "dim_merge_compat": _two_step_sql("gender", compat=True),
        "dim_merge_all": _merge_all_sql(),
        "lookup_age_group": _lookup_sql(None, "age_group"),
        "lookup_location": _lookup_sql("location", "name"),
        "lookup_person_type": _lookup_sql("person_type", "name"),
        "lookup_gender": _lookup_sql("gender", "name"),
        "lookup_grade": _lookup_sql("grade", "name"),
        "lookup_nationality": _lookup_sql("nationality", "name"),
        "lookup_day": _lookup_sql(None, "day"),
        "lookup_informal_org": _lookup_sql("informal_org", "name"),
        "lookup_formal_org": _lookup_sql("formal_org", "name"),
        "lookup_compat": _lookup_sql("gender", "name", folded=False),
        "agg_rule": people + "SELECT gender, count(*) AS people FROM people WHERE is_active GROUP BY gender",
        "fact1_headcount": people.rstrip() + ",\n" + O.headcount_sql("people").strip(),
        "fact2_org_count": people.rstrip() + ",\n" + O.organization_sql("people").strip(),
        "employee_detail": people.rstrip() + ",\n" + O.detail_sql("people").strip(),
        "detail_overwrite": loaded.rstrip() + ",\n" + O.detail_sql("loaded").strip(),
        "fact1_end_to_end": fact1_e2e,
        "fact2_end_to_end": loaded.rstrip() + ",\n" + O.organization_sql("loaded").strip(),
        "fact_idempotent_write": fact1_e2e,
        "dim_merge_high_cardinality": _high_cardinality_sql(),
        "fact1_preloaded_day": fact1_e2e,
        "detail_preloaded_day": loaded.rstrip() + ",\n" + O.detail_sql("loaded").strip(),
        "fact1_after_compat_merge": people.rstrip() + ",\n" + O.headcount_sql("people", spellings=True).strip(),
        "fact_rerun_empty_day": f"SELECT * FROM ({fact1_e2e}) WHERE DayKey <> {EMPTY_DAY:%Y%m%d}",
        "fact_crash_recovery": fact1_e2e,
        "dim_merge_concurrent": people
        + f"SELECT '{EMAIL.name}' AS dim, count(DISTINCT email) AS keys, 1::INTEGER AS first, count(DISTINCT email)::INTEGER AS last, "
        + "count(DISTINCT email) AS members FROM people UNION ALL "
        + f"SELECT '{config.DIM_INFORMAL_ORG}', count(*), 1, count(*)::INTEGER, count(*) FROM ({O.members('informal_org', 'people')})",
        "publish_all": _publish_all_sql(),
        "csv_roundtrip": people.rstrip() + ",\n" + O.headcount_sql("people").strip(),
    }
    return sql
