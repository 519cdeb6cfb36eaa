"""Dense surrogate keys without a single-task window.

New members get ``start + 1, start + 2, ...`` in the order of their natural key
(nulls first), separately per group (for example per dimension when several
dimensions are keyed together). Members are range-partitioned on (group, natural
key) once and written with their range and their place in it; the ranges' sizes
(at most partitions x groups rows) are counted from that file. Places and sizes
therefore always belong to the same ranges, also when the range bounds would be
sampled differently a second time, so keys are dense and unique at any size.

The natural key must be unique within its group (true after distinct /
folding), so the numbering is the same on every run and on every retry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

PLACE_MASK = (1 << 33) - 1  # row position inside a partition, as monotonically_increasing_id holds it


def assign_keys(
    members: DataFrame,
    key: str,
    order_cols: Sequence[str],
    start: int | str = 0,
    group_cols: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add ``key``; ``start`` is an int or the name of a column holding each group's start."""
    spark = members.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = list(group_cols)
    order = [F.col(c).asc_nulls_first() for c in groups + list(order_cols)]

    place = F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_MASK))
    ranged = members.repartitionByRange(n, *order).sortWithinPartitions(*order)
    stored = materialize(ranged.select("*", F.spark_partition_id().alias("_range"), place.alias("_pos")), "ranged")

    # rows of the same group in all lower ranges: a running sum over the counts
    sizes = stored.groupBy("_range", *groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    below = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", *groups, (F.coalesce(F.sum("_n").over(below), F.lit(0)) - F.col("_first")).alias("_offset"))

    # at most n x groups rows; once counted, reading the keys needs no shuffle
    counted = spark.createDataFrame(offsets.collect(), offsets.schema)
    keyed = stored.join(F.broadcast(counted), ["_range", *groups])
    base: Column = F.col(start) if isinstance(start, str) else F.lit(start)
    return keyed.select(
        (base + F.col("_offset") + F.col("_pos") + 1).cast("int").alias(key),
        *[c for c in members.columns if c != start],
    )
