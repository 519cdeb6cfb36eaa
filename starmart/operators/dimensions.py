"""Dimension tables: specs, member folding, insert-only merge, static tables.

A regular dimension is merged from the (unfiltered) source: members not yet in
the table, compared null-safely and case-insensitively, are appended with new
surrogate keys. Members are never updated or deleted, so keys are stable across
runs. A static dimension (age group, day) is preloaded and never merged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.keys import fold, null_safe_match
from ..session import materialize
from . import extractors as X
from .lookups import broadcast_checked, lookup
from .surrogate import assign_keys


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    key: str
    attrs: tuple[str, ...]
    extractor: X.Extractor | None = None  # None: static dimension
    people_cols: Callable[[], list[Column]] | None = None  # lookup's left side
    kind: str = "name"  # "name" | "day"
    schema: T.StructType = field(default=None)  # type: ignore[assignment]

    @property
    def static(self) -> bool:
        return self.extractor is None

    def table_schema(self) -> T.StructType:
        if self.schema is not None:
            return self.schema
        return T.StructType([T.StructField(self.key, T.IntegerType())] + [T.StructField(a, T.StringType()) for a in self.attrs])

    def lookup_step(self, dim: DataFrame, folded: bool = True, rows: int | None = None, unique: bool = False) -> tuple:
        """This lookup as a step for :func:`lookups.lookup_many` (name dimensions only)."""
        cols = self.people_cols() if self.people_cols else []
        return (dim, self.key, cols, self.attrs, folded, rows, unique)

    def lookup(self, people: DataFrame, dim: DataFrame, folded: bool = True, rows: int | None = None, unique: bool = False) -> DataFrame:
        """Add this dimension's key; ``rows`` (if known) spares the size check, ``unique`` the search for several spellings."""
        if self.kind == "day":
            return lookup_day(people, dim, rows)
        cols = self.people_cols() if self.people_cols else []
        return lookup(people, dim, self.key, cols, self.attrs, folded=folded, rows=rows, unique=unique)


def _regular(name: str, key: str, ex: X.Extractor) -> DimensionSpec:
    return DimensionSpec(name, key, ex.attrs, ex, ex.columns)


LOCATION = _regular(config.DIM_LOCATION, "LocationKey", X.LOCATION)
PERSON_TYPE = _regular(config.DIM_PERSON_TYPE, "PersonTypeKey", X.PERSON_TYPE)
GENDER = _regular(config.DIM_GENDER, "GenderKey", X.GENDER)
GRADE = _regular(config.DIM_GRADE, "GradeKey", X.GRADE)
NATIONALITY = _regular(config.DIM_NATIONALITY, "NationalityKey", X.NATIONALITY)
INFORMAL_ORG = _regular(config.DIM_INFORMAL_ORG, "InformalOrgKey", X.INFORMAL_ORG)
FORMAL_ORG = _regular(config.DIM_FORMAL_ORG, "FormalOrgKey", X.FORMAL_ORG)
AGE_GROUP = DimensionSpec(config.DIM_AGE_GROUP, "AgeGroupKey", ("name",), None, lambda: [F.col("age_group")])
DAY = DimensionSpec(
    config.DIM_DAY,
    "DayKey",
    ("year", "month", "day"),
    None,
    None,
    kind="day",
    schema=T.StructType(
        [
            T.StructField("DayKey", T.IntegerType()),
            T.StructField("year", T.IntegerType()),
            T.StructField("month", T.IntegerType()),
            T.StructField("day", T.IntegerType()),
            T.StructField("ExactDate", T.DateType()),
        ]
    ),
)

REGULAR = (LOCATION, PERSON_TYPE, GENDER, GRADE, NATIONALITY, INFORMAL_ORG, FORMAL_ORG)


# ---------------------------------------------------------------------------
# Members and merge
#
# Dimensions are processed together in a "long" layout, one row per member:
# (dim, key, a0, a1, a2, a3), attributes as strings, unused slots null. One
# pass over the source yields every dimension's members, one anti-join finds
# the new ones and one key assignment numbers them per dimension.
# ---------------------------------------------------------------------------

WIDTH = 4  # widest natural key among the regular dimensions
SLOTS = tuple(f"a{i}" for i in range(WIDTH))


def to_long(spec: DimensionSpec, table: DataFrame) -> DataFrame:
    cols = [F.col(a).cast("string").alias(s) for a, s in zip(spec.attrs, SLOTS)]
    cols += [F.lit(None).cast("string").alias(s) for s in SLOTS[len(spec.attrs):]]
    return table.select(F.lit(spec.name).alias("dim"), F.col(spec.key).cast("int").alias("key"), *cols)


def from_long(long: DataFrame, spec: DimensionSpec) -> DataFrame:
    return long.filter(F.col("dim") == spec.name).select(
        F.col("key").alias(spec.key), *[F.col(s).alias(a) for s, a in zip(SLOTS, spec.attrs)]
    )


#: Stands in the ``dim`` column for the snapshot days that a member pass met.
SNAPSHOT_DAYS = "snapshot days"


def dimension_members(
    source: DataFrame,
    specs: tuple[DimensionSpec, ...] | list[DimensionSpec],
    folded: bool = False,
    day: Column | None = None,
) -> DataFrame:
    """Candidate members of several dimensions from one pass over the source.

    Each source row yields one entry per dimension (none where the extractor's
    filter rejects it); one aggregation collapses them with map-side partial
    aggregation: case-sensitive distinct (null is a member), or with ``folded``
    one member per case-folded value directly. ``day`` adds its distinct values
    as rows of ``SNAPSHOT_DAYS``.
    """
    entries = []
    if day is not None:
        blank = [F.lit(None).cast("string").alias(a) for a in SLOTS[1:]]
        entries.append(F.struct(F.lit(SNAPSHOT_DAYS).alias("dim"), day.cast("string").alias(SLOTS[0]), *blank))
    for s in specs:
        cols = s.extractor.columns() + [F.lit(None)] * (WIDTH - len(s.attrs))
        entry = F.struct(F.lit(s.name).alias("dim"), *[c.cast("string").alias(a) for a, c in zip(SLOTS, cols)])
        if s.extractor.keep is not None:
            entry = F.when(s.extractor.keep(), entry)
        entries.append(entry)
    exploded = source.select(F.explode(F.array(*entries)).alias("m")).filter(F.col("m").isNotNull()).select("m.*")
    # Distinct first: a hash aggregate with map-side combining. Folding takes
    # min() of structs, which Spark runs as a sort aggregate, so it runs on the
    # few distinct members rather than on every source row.
    distinct = exploded.distinct()
    return fold_members(distinct) if folded else distinct


def fold_members(members: DataFrame, attrs: tuple[str, ...] = SLOTS, by: tuple[str, ...] = ("dim",)) -> DataFrame:
    """One member per case-folded value: the smallest of its rows, compared attribute by attribute."""
    by = tuple(b for b in by if b in members.columns)
    groups = [F.col(b) for b in by] + [fold(a).alias(f"_f_{i}") for i, a in enumerate(attrs)]
    return members.groupBy(*groups).agg(F.min(F.struct(*attrs)).alias("_m")).select(*by, *[f"_m.{a}" for a in attrs])


def new_members(members: DataFrame, existing: DataFrame, compat: bool = False, folded: bool = False) -> DataFrame:
    """Members (long layout) whose folded value is not in ``existing`` yet (left anti join).

    Default folds first, so spellings differing only in case that arrive
    together give one member; ``compat`` keeps every case-sensitive spelling.
    ``folded`` says ``members`` is folded already.
    """
    new = members if (compat or folded) else fold_members(members)
    old = existing.select(F.col("dim").alias("_old_dim"), *[F.col(s).alias(f"_old_{s}") for s in SLOTS])
    cond = (new["dim"] == old["_old_dim"]) & null_safe_match(
        [new[s] for s in SLOTS], [old[f"_old_{s}"] for s in SLOTS], folded=True
    )
    # Both sides hold dimension members only; AQE turns this into a broadcast
    # join when the stored tables are small at run time, else it stays a
    # shuffle join on the member key.
    return new.join(old, cond, "left_anti")


def key_members(new: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Keys for new members, continuing after each dimension's largest key (from 1 if none)."""
    if existing is None:
        return assign_keys(new, "key", SLOTS, start=0, group_cols=("dim",)).select("dim", "key", *SLOTS)
    starts = existing.groupBy("dim").agg(F.max("key").alias("_start"))  # one row per dimension
    with_start = new.join(F.broadcast(starts), "dim", "left").withColumn(
        "_start", F.coalesce(F.col("_start"), F.lit(0))
    )
    return assign_keys(with_start, "key", SLOTS, start="_start", group_cols=("dim",)).select("dim", "key", *SLOTS)


def member_rows(source: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Case-sensitive distinct members of one dimension, without keys, as a merge reads them."""
    return from_long(dimension_members(source, [spec]).withColumn("key", F.lit(None).cast("int")), spec).drop(spec.key)


def member_counts(long: DataFrame) -> dict[str, int]:
    """Rows per dimension (one small action over at most one row per dimension)."""
    return {r["dim"]: r["n"] for r in long.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}


def build_dimensions(
    people: DataFrame, specs: tuple[DimensionSpec, ...] = REGULAR, compat: bool = False
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Dimensions as first merges build them from ``people``, and their row counts.

    The distinct members are stored before they are folded and numbered, which takes several
    looks at them; the keyed members are read from the file that the key assignment wrote.
    """
    met = materialize(dimension_members(people, specs), "members")
    keyed = key_members(met if compat else fold_members(met), None)
    counts = member_counts(keyed)
    return {spec.name: from_long(keyed, spec) for spec in specs}, {s.name: counts.get(s.name, 0) for s in specs}


# ---------------------------------------------------------------------------
# Static dimensions
# ---------------------------------------------------------------------------

def age_group_table(spark: SparkSession) -> DataFrame:
    """Key 0 is the null band (under 18 or unknown age), then the bands in order."""
    rows = [(0, None)] + [(i + 1, label) for i, (label, _, _) in enumerate(config.AGE_BANDS)]
    return spark.createDataFrame(rows, AGE_GROUP.table_schema())


def day_table(spark: SparkSession, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """One row per calendar day from ``first`` to ``last``; DayKey is yyyymmdd."""
    first_d = dt.date.fromisoformat(str(first))
    last_d = dt.date.fromisoformat(str(last))
    days = spark.range(0, (last_d - first_d).days + 1)
    d = F.date_add(F.lit(first_d.isoformat()).cast("date"), F.col("id").cast("int"))
    return days.select(d.alias("ExactDate")).select(
        (F.year("ExactDate") * 10000 + F.month("ExactDate") * 100 + F.dayofmonth("ExactDate")).alias("DayKey"),
        F.year("ExactDate").alias("year"),
        F.month("ExactDate").alias("month"),
        F.dayofmonth("ExactDate").alias("day"),
        "ExactDate",
    )


def lookup_day(people: DataFrame, day: DataFrame, rows: int | None = None) -> DataFrame:
    """Equi-join on (year, month, day); adds DayKey and ExactDate."""
    right = day.select("DayKey", "year", "month", "day", "ExactDate")
    return people.join(broadcast_checked(right, rows=rows), ["year", "month", "day"])
