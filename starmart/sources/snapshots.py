"""Snapshot loading: scan the partitioned snapshot tree, keep the chosen runs.

Full load keeps the latest successful run of every day; incremental load keeps
only days after the last loaded path, and lists only those days' folders. Both
end in an inner join of the tree with the chosen runs on the five partition
keys. The chosen runs (about one row per day) are written once, so the history is
read once and Spark knows their size: it broadcasts them while they are small,
and a broadcast join on partition columns prunes partitions dynamically.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.paths import parse_watermark
from ..operators.history import after_day, latest_runs, run_keys, successful_runs, with_path_parts
from .. import storage
from ..schemas import PEOPLE_SNAPSHOT
from ..session import materialize
from . import avro


def read_run_history(warehouse, table: str = config.HISTORY_TABLE, options: Mapping[str, str] | None = None) -> DataFrame:
    """The ETL run history table (a JDBC table in production).

    The success / data source / ETL filters applied by :func:`chosen_runs` are
    plain column predicates, so Spark pushes them into the database query.
    """
    return warehouse.read(table, options=options)


def tree_folders(spark: SparkSession, root: str, parts: tuple[str, ...], wanted: Callable[[tuple], bool]) -> list[tuple[tuple, str]]:
    """(values, folder) below ``root`` for folders ``part=value`` of all ``parts``; ``wanted`` takes or leaves the values so far.

    Numbers compare as numbers, however they are padded; only wanted folders are listed.
    """
    level: list[tuple[tuple, str]] = [((), root.rstrip("/"))]
    for part in parts:
        below = []
        for key, folder in level:
            for name in storage.children(spark, folder):
                label, _, value = name.partition("=")
                found = (*key, int(value) if value.isdigit() else value)
                if label == part and wanted(found):
                    below.append((found, f"{folder}/{name}"))
        level = below
    return level


def day_folders(spark: SparkSession, root: str, after: tuple[str, str, str]) -> list[str]:
    """Folders of the days after (year, month, day), listing only the years and months they lie in."""
    limit = tuple(int(x) for x in after)
    days = tree_folders(spark, root, config.DAY_PARTS, lambda key: isinstance(key[-1], int) and key >= limit[: len(key)])
    return [folder for key, folder in days if key > limit]


def run_folders(spark: SparkSession, root: str, runs: DataFrame) -> list[str]:
    """Folders of chosen runs (about one a calendar day reach the driver)."""
    keys = {tuple(r) for r in runs.select(*config.PARTITION_KEYS).collect()}
    prefixes = {k[:n] for k in keys for n in range(1, len(k) + 1)}
    return [folder for _, folder in tree_folders(spark, root, config.PARTITION_KEYS, prefixes.__contains__)]


def scan_snapshots(
    spark: SparkSession,
    root: str,
    schema: T.StructType = PEOPLE_SNAPSHOT,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    folders: list[str] | None = None,
) -> DataFrame:
    """Directory-partitioned tree with an imposed schema; ``folders`` limits it to parts of the tree.

    ``fmt`` is a format of Spark, or "avro" for the container files of :mod:`.avro`.
    """
    if folders is not None and not folders:
        return spark.createDataFrame([], schema)
    if fmt == "avro":
        source = spark.read.format(avro.register(spark)).schema(schema).options(**{"tasks": 3 * spark.sparkContext.defaultParallelism, **dict(options or {})}, basePath=root)
        return source.load(root) if folders is None else source.option("folders", json.dumps(folders)).load(root)
    reader = spark.read.schema(schema).format(fmt).options(**dict(options or {}))
    return reader.load(root) if folders is None else reader.option("basePath", root).load(folders)


def chosen_runs(
    history: DataFrame,
    data_source: str = config.MODEL_DATA_SOURCE,
    etl: str = config.FULL_USER_INFO_ETL,
    since: str | None = None,
    compat: bool = False,
) -> DataFrame:
    """Partition keys (year, month, day, hour, etlid) of the runs to load, as ints + string."""
    runs = with_path_parts(successful_runs(history, data_source, etl), compat)
    best = latest_runs(runs)
    if since is not None:
        best = best.filter(after_day("year", "month", "day", parse_watermark(since, compat), compat))
    keys = run_keys(best)
    if compat:  # string parts meet int partition columns; unparsable parts do not join
        keys = keys.select(*[F.col(c).try_cast("int").alias(c) for c in ("year", "month", "day", "hour")], "etlid")
    return keys


def load_snapshots(
    spark: SparkSession,
    root: str,
    history: DataFrame,
    data_source: str = config.MODEL_DATA_SOURCE,
    etl: str = config.FULL_USER_INFO_ETL,
    since: str | None = None,
    schema: T.StructType = PEOPLE_SNAPSHOT,
    fmt: str = "parquet",
    compat: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Snapshot rows of the chosen runs, with the partition columns and nothing from history."""
    keys = chosen_runs(history, data_source, etl, since, compat)
    folders = day_folders(spark, root, parse_watermark(since)) if since is not None and not compat else None
    runs = materialize(keys, "chosen-runs")
    if fmt == "avro":  # a source outside Spark's own isn't pruned by a join, so its folders are chosen here
        folders = run_folders(spark, root, runs)
    snap = scan_snapshots(spark, root, schema, fmt, options, folders)
    # Spark prunes partitions by a join's small side only if a comparison filters that side.
    runs = runs.where(F.col("hour") >= 0)
    return snap.join(runs, list(config.PARTITION_KEYS))
