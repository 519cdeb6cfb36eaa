"""Helpers shared by the operators: tables, free column names, global ranks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart import storage
from starmart.session import materialize

#: Characters between words: space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Row position inside a partition, as monotonically_increasing_id holds it.
POSITION_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(taken: DataFrame | Iterable[str], *wanted: str) -> list[str]:
    """Names like ``wanted`` that clash with no column of ``taken`` (underscores are added)."""
    used = {c.lower() for c in (taken.columns if isinstance(taken, DataFrame) else taken)}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: Sequence[Column], rank: str, label: str) -> DataFrame:
    """``df`` with its 0-based position in ``order`` over all rows.

    Rows are range-partitioned once and written with their range and their place
    in it; the offsets of the ranges (one row a range) come from that file, so
    sizes and places always belong to the same ranges.
    """
    spark = df.sparkSession
    part, pos, size = free_names(df, "_range", "_pos", "_size")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    stored = materialize(
        df.repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias(part), place.alias(pos)),
        label,
    )
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias(size))
    below = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum(size).over(below), F.lit(0)).alias(size))
    return (
        stored.join(F.broadcast(offsets), part)  # one row a shuffle partition
        .withColumn(rank, F.col(size) + F.col(pos))
        .drop(part, pos, size)
    )


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps (it acts when the JVM collects garbage)."""
    spark.sparkContext._jvm.System.gc()


def discard(*written: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote and that no step to come, or to be repeated, reads."""
    for df in written:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            storage.remove(df.sparkSession, folder)


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a whole text."""
    return F.unhex(F.md5(text.cast("binary")))
