"""Facts: specifications, the refresh, and publishing.

A fact refresh: merge the regular dimensions (all members gathered in one pass
over the source) -> read the dimensions -> filter and derive -> look up every
key -> aggregate -> write the fact and count it -> (headcount only) overwrite
the employee detail with the latest day's people. The fact's days, the days it
leaves empty and the detail become visible together. Nothing is cached; every pass
reads only the columns it needs, and a publish reads its source once.
"""

from __future__ import annotations

import datetime as dt
import functools
import logging
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.people import age, age_band, on_day
from ..operators import dimensions as D
from ..operators.detail import detail_columns
from ..operators.extractors import FORMAL_ORG_COLUMNS, INFORMAL_ORG_COLUMNS
from ..operators.filters import fact_filters
from ..operators.lookups import lookup_many
from ..operators.rules import Rule, aggregation, apply_rules
from ..schemas import EMPLOYEE_DETAIL
from ..session import materialize, scratch_scope
from ..sources.warehouse import Conflict

log = logging.getLogger(__name__)

# FIXED VALUES (output schema): the facts' key columns.
HEADCOUNT_KEYS = (
    "AgeGroupKey",
    "LocationKey",
    "GradeKey",
    "PersonTypeKey",
    "NationalityKey",
    "GenderKey",
    "DayKey",
    "InformalOrgKey",
    "FormalOrgKey",
)
ORGANIZATION_KEYS = ("DayKey", "InformalOrgKey", "FormalOrgKey")


# ---------------------------------------------------------------------------
# Derivation rules
# ---------------------------------------------------------------------------

def with_age(as_of: dt.date | str | None) -> Rule:
    def apply(df: DataFrame) -> DataFrame:
        a = age("date_of_birth", as_of)
        return df.withColumns({"age": a, "age_group": age_band(a)})

    return apply


def with_new_hire(as_of: dt.date | str | None) -> Rule:
    return lambda df: df.withColumn("is_new_hire", on_day("hire_date", as_of))


def with_separation(as_of: dt.date | str | None) -> Rule:
    return lambda df: df.withColumn("is_separation", on_day("end_date", as_of))


def derivations(as_of: dt.date | str | None) -> list[Rule]:
    return [with_age(as_of), with_new_hire(as_of), with_separation(as_of)]


def org_columns_only(df: DataFrame) -> DataFrame:
    """Narrow to the columns the organisation fact needs before any join."""
    cols = [s for s, _ in INFORMAL_ORG_COLUMNS] + [s for s, _ in FORMAL_ORG_COLUMNS] + list(config.DAY_PARTS)
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Specs
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class FactSpec:
    name: str
    merged: tuple[D.DimensionSpec, ...]  # regular dimensions this fact maintains
    lookups: tuple[D.DimensionSpec, ...]  # dimensions whose keys the fact carries
    transformations: tuple[Rule, ...]
    aggregate: Rule
    detail: bool = False


def headcount_fact(as_of: dt.date | str | None = None) -> FactSpec:
    return FactSpec(
        name=config.FACT_HEADCOUNT,
        merged=D.REGULAR,
        lookups=(
            D.LOCATION,
            D.PERSON_TYPE,
            D.GENDER,
            D.GRADE,
            D.NATIONALITY,
            D.AGE_GROUP,
            D.DAY,
            D.INFORMAL_ORG,
            D.FORMAL_ORG,
        ),
        transformations=tuple(fact_filters() + derivations(as_of)),
        aggregate=aggregation(
            HEADCOUNT_KEYS,
            F.count(F.lit(1)).alias("EmployeeCount"),
            F.sum("is_new_hire").cast("long").alias("NewHireCount"),
            F.sum("is_separation").cast("long").alias("SeparationCount"),
        ),
        detail=True,
    )


def organization_fact() -> FactSpec:
    """Counts people rows per (day, informal org, formal org); does not merge."""
    return FactSpec(
        name=config.FACT_ORGANIZATION,
        merged=(),
        lookups=(D.INFORMAL_ORG, D.FORMAL_ORG, D.DAY),
        transformations=tuple(fact_filters() + [org_columns_only]),
        aggregate=aggregation(ORGANIZATION_KEYS, F.count(F.lit(1)).alias("OrganizationCount")),
    )


# ---------------------------------------------------------------------------
# Frames (no I/O)
# ---------------------------------------------------------------------------

def lookup_frame(
    spec: FactSpec,
    source: DataFrame,
    dims: Mapping[str, DataFrame],
    folded: bool = True,
    sizes: Mapping[str, int] | None = None,
    unique: Collection[str] = (),
) -> DataFrame:
    """Filters and derivations, then every lookup (broadcast joins for small dimensions).

    ``unique`` names the dimensions known to have one row a folded value.
    """
    out = apply_rules(source, spec.transformations)
    sizes = sizes or {}
    names = [d for d in spec.lookups if d.kind != "day"]
    if names:
        out = lookup_many(out, [d.lookup_step(dims[d.name], folded, sizes.get(d.name), d.name in unique) for d in names])
    for d in spec.lookups:
        if d.kind == "day":
            out = d.lookup(out, dims[d.name], folded, sizes.get(d.name))
    return out


def fact_frame(
    spec: FactSpec,
    source: DataFrame,
    dims: Mapping[str, DataFrame],
    folded: bool = True,
    sizes: Mapping[str, int] | None = None,
    unique: Collection[str] = (),
) -> DataFrame:
    return spec.aggregate(lookup_frame(spec, source, dims, folded, sizes, unique))


def table_sizes(warehouse, names: Sequence[str]) -> dict[str, int]:
    """Row counts of several warehouse tables: one scan of all of them, one shuffle."""
    parts = [warehouse.read(n).select(F.lit(n).alias("t")) for n in names]
    union = functools.reduce(lambda a, b: a.unionByName(b), parts)
    counts = {r["t"]: r["n"] for r in union.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {n: counts.get(n, 0) for n in names}


# ---------------------------------------------------------------------------
# Refresh with a warehouse
# ---------------------------------------------------------------------------

def snapshot_day(prefix: str = "") -> F.Column:
    return F.make_date(F.col(prefix + "year"), F.col(prefix + "month"), F.col(prefix + "day"))


def snapshot_days(source: DataFrame) -> list[dt.date]:
    """The snapshot days of a source (calendar days only reach the driver)."""
    days = source.select(snapshot_day().alias("day")).distinct().where("day IS NOT NULL")
    return sorted(r["day"] for r in days.collect())


def ensure_static_dimensions(warehouse, spark: SparkSession, found: Sequence[dt.date]) -> None:
    """Seed the age groups and the day table if they are absent; ``found`` are the source's days in order.

    A day table that is there keeps its rows and keys. Only one whose keys are all
    of the form yyyymmdd, as seeded here, gets the years it lacks; days are
    compared by (year, month, day). A table with keys of its own is left alone.
    """
    if not warehouse.exists(D.AGE_GROUP.name):
        warehouse.write(D.age_group_table(spark), D.AGE_GROUP.name, mode="overwrite", unique=True)
    if not found:
        return
    days = D.day_table(spark, dt.date(found[0].year, 1, 1), dt.date(found[-1].year, 12, 31))
    if not warehouse.exists(D.DAY.name):
        warehouse.write(days, D.DAY.name, mode="append")
        return
    existing = warehouse.read(D.DAY.name, D.DAY.table_schema())
    own = F.col("DayKey") == F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    if existing.agg(F.count_if(~F.coalesce(own, F.lit(False)))).first()[0]:
        return
    missing = materialize(days.join(existing, list(config.DAY_PARTS), "left_anti"), "new-days")
    if not missing.isEmpty():
        warehouse.write(missing.select(*days.columns), D.DAY.name, mode="append")


def merge_dimensions(
    warehouse, source: DataFrame, specs: Sequence[D.DimensionSpec], compat: bool = False
) -> dict[str, int]:
    """Insert-only merge of regular dimensions; returns rows appended per table."""
    return merge_with_days(warehouse, source, specs, compat)[0]


def merge_with_days(
    warehouse, source: DataFrame, specs: Sequence[D.DimensionSpec], compat: bool = False
) -> tuple[dict[str, int], list[dt.date]]:
    """``merge_dimensions``, and the snapshot days met in its pass over the source.

    All dimensions go through one member pass, one anti-join against the
    current tables and one key assignment, and their appends become visible
    together. If another publisher has changed one of the tables meanwhile, the new
    members are found and numbered again against the newer tables, so that members
    and keys stay unique.
    """
    if not specs:
        return {}, snapshot_days(source)
    met = materialize(D.dimension_members(source, specs, day=snapshot_day()), "members")
    days = met.where(F.col("dim") == D.SNAPSHOT_DAYS).where("a0 IS NOT NULL").select("a0").distinct().collect()
    members = met.where(F.col("dim") != D.SNAPSHOT_DAYS)
    members = members if compat else D.fold_members(members)
    while True:
        try:
            with warehouse.refresh(rely_on=[s.name for s in specs]):
                counts = append_members(warehouse, members, specs, compat)
            return counts, sorted(dt.date.fromisoformat(r["a0"]) for r in days)
        except Conflict as e:
            log.info("merging again: %s", e)


def append_members(warehouse, members: DataFrame, specs: Sequence[D.DimensionSpec], compat: bool) -> dict[str, int]:
    """Append the members that the tables lack; returns how many per table.

    The new members are stored with their keys before the appends, so no append
    re-reads the table it grows; the counts are taken from that file. Where the
    store assigns keys itself, the attributes are appended without any.
    """
    present = {spec.name: warehouse.exists(spec.name) for spec in specs}
    if any(present.values()):
        existing = functools.reduce(
            lambda a, b: a.unionByName(b),
            [D.to_long(s, warehouse.read(s.name, s.table_schema())) for s in specs if present[s.name]],
        )
        members = D.new_members(members, existing, compat, folded=not compat)
    else:
        existing = None  # first publish: every member is new and keys start at 1
    if warehouse.assigns_keys:
        new = materialize(members.withColumn("key", F.lit(None).cast("int")), "new-members")
    else:
        new = D.key_members(members, existing)  # reads only the file that the key assignment wrote
    counts = D.member_counts(new)
    for spec in specs:
        n = counts.get(spec.name, 0)
        if n or not present[spec.name]:
            log.info("appending %d members to %s", n, spec.name)
            rows = D.from_long(new, spec)
            unique = not compat and (not present[spec.name] or warehouse.unique(spec.name))
            warehouse.write(rows.drop(spec.key) if warehouse.assigns_keys else rows, spec.name, mode="append", unique=unique)
    return {spec.name: counts.get(spec.name, 0) for spec in specs}


def update_fact(
    spec: FactSpec,
    warehouse,
    source: DataFrame,
    read_options: Mapping[str, str] | None = None,
    write_options: Mapping[str, str] | None = None,
    compat: bool = False,
    static_ready: bool = False,
    people: DataFrame | None = None,
) -> int:
    """Refresh one fact from a loaded snapshot frame; returns the fact's row count.

    Nothing of the source is cached: each pass reads only the columns it needs
    (the member pass the dimension columns, the fact pass the lookup and
    measure columns). Days of the source that a refresh leaves without rows are
    cleared, so a day's rows are always those of its last run. Rows and days are
    those of the stored files. The detail needs the latest day that survives
    the lookups, which is the latest of the days written, so the detail pass reads
    that day's partitions only, from ``people`` if ``source`` lacks its columns. What
    the refresh stores aside is removed at its end.
    """
    spark = source.sparkSession
    with scratch_scope(spark):
        _, days = merge_with_days(warehouse, source, spec.merged, compat)
        if not static_ready:
            ensure_static_dimensions(warehouse, spark, days)
        if not days:  # nothing loaded: facts and detail stay as they are
            if spec.detail:
                ensure_detail(warehouse, spark)
            return 0
        dims = {d.name: warehouse.read(d.name, d.table_schema(), options=read_options) for d in spec.lookups}
        known = Known(table_sizes(warehouse, [d.name for d in spec.lookups]), {d.name for d in spec.lookups if warehouse.unique(d.name)}, not compat)
        with warehouse.refresh():
            again = warehouse.exists(spec.name)
            fact = fact_frame(spec, source, dims, known.folded, known.sizes, known.unique)
            written = write_counted(warehouse, fact, spec.name, write_options)
            if again:
                clear_empty_days(warehouse, spec.name, days, dims[D.DAY.name], set(written))
            if spec.detail:
                latest = latest_of(dims[D.DAY.name], written)
                overwrite_detail(warehouse, spec, source if people is None else people, dims, known, latest, write_options)
        return sum(written.values())


@dataclass(frozen=True)
class Known:
    """What a refresh knows of its dimensions: rows, which have one row a folded value, and whether lookups fold."""

    sizes: Mapping[str, int]
    unique: Collection[str] = ()
    folded: bool = True


def write_counted(warehouse, fact: DataFrame, name: str, options: Mapping[str, str] | None = None) -> dict[int, int]:
    """Write a fact; returns the rows of each day, counted from stored files.

    A store that keeps no files of its own gets the fact from a file written aside, and the counts are that file's.
    """
    if warehouse.versioned:
        return warehouse.write_fact(fact, name, options=options)
    aside, counts = counted(fact)
    warehouse.write_fact(aside, name, options=options)
    return counts


def counted(fact: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """A fact written aside, and the rows of each day in that file (calendar days only reach the driver)."""
    aside = materialize(fact, "fact")
    return aside, {r["DayKey"]: r["count"] for r in aside.groupBy("DayKey").count().collect()}


def latest_of(day: DataFrame, keys: Collection[int]) -> dt.date | None:
    """The latest date of day keys (calendar days only reach the driver)."""
    return day.where(F.col("DayKey").isin(sorted(keys))).agg(F.max("ExactDate")).first()[0] if keys else None


def clear_empty_days(warehouse, name: str, days: Sequence[dt.date], day: DataFrame, written: set[int]) -> list[int]:
    """Clear the fact's days that the source covers but that got no rows (calendar days only reach the driver)."""
    parts = [(d.year, d.month, d.day) for d in days]
    covered = source_days(day.sparkSession, parts).join(day, list(config.DAY_PARTS)).select("DayKey").collect()
    return warehouse.clear_days(name, sorted({r["DayKey"] for r in covered} - written))


def source_days(spark: SparkSession, parts: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(parts), "year int, month int, day int")


def detail_frame(
    spec: FactSpec,
    source: DataFrame,
    dims: Mapping[str, DataFrame],
    latest: dt.date,
    folded: bool = True,
    sizes: Mapping[str, int] | None = None,
    unique: Collection[str] = (),
) -> DataFrame:
    """The people of the day ``latest`` that survive the filters and lookups, as detail rows.

    The day's (year, month, day) comes from the day table and filters the source
    before the lookups, so only that day's partitions are read.
    """
    parts = dims[D.DAY.name].where(F.col("ExactDate") == F.lit(latest)).select(*config.DAY_PARTS).distinct().collect()
    wanted = functools.reduce(
        lambda a, b: a | b,
        [(F.col("year") == r["year"]) & (F.col("month") == r["month"]) & (F.col("day") == r["day"]) for r in parts],
        F.lit(False),
    )
    looked = lookup_frame(spec, source.filter(wanted), dims, folded, sizes, unique)
    return looked.where(F.col("ExactDate") == F.lit(latest)).select(*detail_columns())


def overwrite_detail(
    warehouse, spec: FactSpec, people: DataFrame, dims: Mapping[str, DataFrame], known: Known, latest: dt.date | None, write_options: Mapping[str, str] | None = None
) -> bool:
    """Replace the employee detail with the people of the latest day written; keep it when no day was.

    A store that changes at once gets rows that were written aside, and only if there are any.
    """
    if latest is not None:
        detail = detail_frame(spec, people, dims, latest, known.folded, known.sizes, known.unique)
        if not warehouse.versioned:
            detail = materialize(detail, "detail")
        if warehouse.versioned or not detail.isEmpty():
            opts = {"truncate": "true", **dict(write_options or {})}
            warehouse.write(detail, config.EMPLOYEE_DETAIL, mode="overwrite", options=opts)
            return True
    ensure_detail(warehouse, people.sparkSession)
    return False


def ensure_detail(warehouse, spark: SparkSession) -> None:
    """An empty detail table where there is none yet."""
    if not warehouse.exists(config.EMPLOYEE_DETAIL):
        warehouse.write(spark.createDataFrame([], EMPLOYEE_DETAIL), config.EMPLOYEE_DETAIL, mode="overwrite")


# Columns of the people that the member pass and both facts read.
EXTRACT = (
    "gender", "grade", "nationality", "user_type", "work_location", "is_active", "worker_type", "assignment_status",
    "date_of_birth", "hire_date", "end_date", "org_business_unit", "org_service_line", "org_function", "org_department",
    "business_group", "operating_unit", *config.DAY_PARTS,
)


def publish(
    warehouse,
    source: DataFrame,
    as_of: dt.date | str | None = None,
    read_options: Mapping[str, str] | None = None,
    write_options: Mapping[str, str] | None = None,
    compat: bool = False,
) -> dict[str, int]:
    """Headcount first (it maintains the shared dimensions and the day table), then organisation.

    The source is read once, into an extract of the columns that the member pass and the
    facts need; only the detail reads the source again, and only its latest day.
    """
    out = {}
    with scratch_scope(source.sparkSession):
        extract = materialize(source.select(*EXTRACT), "people")
        for spec in (headcount_fact(as_of), organization_fact()):
            ready = spec.name != config.FACT_HEADCOUNT
            out[spec.name] = update_fact(spec, warehouse, extract, read_options, write_options, compat, static_ready=ready, people=source)
    return out
