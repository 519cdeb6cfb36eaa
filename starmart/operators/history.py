"""Run history: which snapshot run of each day is loaded.

A history row describes one ETL run (status, data source, ETL name, output path,
start time, run id). The partition parts are read off the path, and for every
day the run with the greatest hour, then the greatest start, is kept; exact ties
are all kept, and a day whose best run has no start time is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.paths import path_part

RUN_PARTS = ("year", "month", "day", "hour")


def successful_runs(
    history: DataFrame,
    data_source: str = config.MODEL_DATA_SOURCE,
    etl: str = config.FULL_USER_INFO_ETL,
) -> DataFrame:
    return history.filter(
        (F.col("status") == config.SUCCESS_STATUS)
        & (F.col("datasource_name") == data_source)
        & (F.col("etl_name") == etl)
    )


def with_path_parts(history: DataFrame, compat: bool = False) -> DataFrame:
    """Add year, month, day, hour parsed from ``data_path`` (ints; strings in compat)."""
    return history.withColumns({p: path_part("data_path", p, compat) for p in RUN_PARTS})


def latest_runs(runs: DataFrame) -> DataFrame:
    """Rows of the latest run per day (aggregate form).

    The best (hour, start) per day comes from a grouped max, which Spark computes
    with map-side partial aggregation, so a day holding a large share of all runs
    costs no more than any other. The per-day result (one row per calendar day)
    is joined back on equality; null hour or start never match, so a day whose
    best run has a null start drops out, and exact ties all stay.
    """
    best = runs.groupBy(*config.DAY_PARTS).agg(F.max(F.struct("hour", "start")).alias("_best"))
    best = best.select(
        *[F.col(c).alias(f"_b_{c}") for c in config.DAY_PARTS],
        F.col("_best.hour").alias("_b_hour"),
        F.col("_best.start").alias("_b_start"),
    )
    cond = [runs[c].eqNullSafe(F.col(f"_b_{c}")) for c in config.DAY_PARTS]
    cond += [runs["hour"] == F.col("_b_hour"), runs["start"] == F.col("_b_start")]
    # run-history sized on both sides: AQE broadcasts at run time when small
    joined = runs.join(best, cond)
    return joined.select(*runs.columns)


def latest_runs_ranked(runs: DataFrame) -> DataFrame:
    """Same rows as :func:`latest_runs`, by ``rank() == 1`` over a day window."""
    w = Window.partitionBy(*config.DAY_PARTS).orderBy(F.col("hour").desc_nulls_last(), F.col("start").desc_nulls_last())
    ranked = runs.withColumn("_rank", F.rank().over(w))
    keep = (F.col("_rank") == 1) & F.col("start").isNotNull() & F.col("hour").isNotNull()
    return ranked.filter(keep).drop("_rank")


def day_first_values(runs: DataFrame) -> DataFrame:
    """Per run, the hour and start of its day's first run (ordered hour, start descending)."""
    w = Window.partitionBy(*config.DAY_PARTS).orderBy(F.col("hour").desc_nulls_last(), F.col("start").desc_nulls_last())
    return runs.withColumns({"last_hour": F.first("hour").over(w), "last_start": F.first("start").over(w)})


def run_keys(runs: DataFrame) -> DataFrame:
    """The five snapshot partition keys of the chosen runs (history columns stay out)."""
    return runs.select(*RUN_PARTS, F.col("run_guid").alias("etlid"))


def after_day(year: Column | str, month: Column | str, day: Column | str, ymd: tuple[str, str, str], compat: bool = False) -> Column:
    """Partition day strictly after the watermark day ``ymd``.

    Default: (year, month, day) compared as one calendar value on ints.
    ``compat``: each part compared on its own as a string (year >= y, month >= m,
    day > d), which skips days 1..d of every later month.
    """
    y, m, d = (F.col(c) if isinstance(c, str) else c for c in (year, month, day))
    if compat:
        return (y >= F.lit(ymd[0])) & (m >= F.lit(ymd[1])) & (d > F.lit(ymd[2]))
    wy, wm, wd = (int(v) for v in ymd)
    return (y > wy) | ((y == wy) & (m > wm)) | ((y == wy) & (m == wm) & (d > wd))
