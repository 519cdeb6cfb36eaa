"""Sharding by Hilbert-curve order (operator 1).

Several metadata dimensions are quantised to cells, each row gets the index of
its cell on a Hilbert curve, rows are ordered by that index and the order is cut
into runs of equal length. Rows near each other on the curve are near in every
dimension, so a shard's ranges of source, language, size and id are narrow and
a reader can skip shards by any of them (``zone_map``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, ranked

SHARDS = 40
BITS = 8  # of a cell in each dimension
DIMENSIONS = 4
OVERHEAD = 16  # bytes of a record besides its text


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each column of ``cells`` (dimensions x rows, values below 2**bits)."""
    x = cells.astype(np.uint64).copy()
    dims, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        low = (one << np.uint64(level)) - one
        for i in range(dims):
            high = (x[i] >> np.uint64(level)) & one == one
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap if i else np.uint64(0)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        high = (x[dims - 1] >> np.uint64(level)) & one == one
        turn ^= np.where(high, (one << np.uint64(level)) - one, np.uint64(0))
    x ^= turn
    index = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << one) | ((x[i] >> np.uint64(level)) & one)
    return index


@F.pandas_udf(T.LongType())
def curve(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack([s.to_numpy(np.uint64) for s in (a, b, c, d)]), BITS).astype(np.int64))


def name_cell(name: Column) -> Column:
    """Cell of a categorical value: the top bits of its crc32; null is cell 0."""
    return F.coalesce(F.shiftright(F.crc32(name), 32 - BITS), F.lit(0))


def size_cell(size: Column) -> Column:
    """Cell of a size on a log scale: its bit length and the two bits after the first."""
    digits = F.bin(size)
    return F.least((F.length(digits) - 1) * 4 + F.conv(F.substring(digits, 2, 2), 2, 10).cast("int"), F.lit((1 << BITS) - 1))


def hilbert_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    name_cols: tuple[str, str] = ("source", "lang"),
    shards: int = SHARDS,
    out: str = "shard",
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (the id by default) with a struct ``out``: size, text_crc32, curve, shard, slot.

    Law ``rows``: the curve order is cut into runs whose lengths differ by one at
    most; ``slot`` counts from 0 inside a shard. Equal texts of one source and
    language lie together, and ties are ordered by doc_id, nulls first; rows equal
    in all of these are interchangeable. A null text has 0 bytes; a null source,
    language or id falls into cell 0. With fewer rows than shards the last shards
    stay empty; an empty table gives no rows.
    """
    keep = [id_col] if keep is None else keep
    lo, hi, n = docs.agg(F.min(id_col), F.max(id_col), F.count(F.lit(1))).first()
    lo, shift = lo or 0, max(0, ((hi or 0) - (lo or 0)).bit_length() - BITS)
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + OVERHEAD
    ident = F.col(id_col).cast("long")
    id_cell = F.coalesce(F.shiftright(ident, shift) - F.lit(lo >> shift), F.lit(0))
    id_cell = F.least(id_cell, F.lit((1 << BITS) - 1))
    names = free_names(keep, "_size", "_crc", "_id", "_curve", "_row")
    size_c, crc, order_id, index, row = names
    cells = docs.select(
        *keep,
        size.alias(size_c),
        F.coalesce(F.crc32(F.col(text_col)), F.lit(0)).alias(crc),
        ident.alias(order_id),
        curve(name_cell(F.col(name_cols[0])), name_cell(F.col(name_cols[1])), size_cell(size), id_cell).alias(index),
    )
    placed = ranked(cells, [F.col(index), F.col(crc), F.col(order_id).asc_nulls_first()], row, "curve")
    base, extra = divmod(n, shards)
    big = extra * (base + 1)  # rows in the first shards, which hold one more
    at = F.col(row)
    shard = F.when(at < big, F.floor(at / F.lit(base + 1))).otherwise(extra + F.floor((at - big) / F.lit(max(base, 1))))
    first = F.when(at < big, shard * (base + 1)).otherwise(big + (shard - extra) * base)
    return placed.select(
        *keep,
        F.struct(
            F.col(size_c).alias("size"),
            F.col(crc).alias("text_crc32"),
            F.col(index).alias("curve"),
            shard.cast("int").alias("shard"),
            (at - first).cast("long").alias("slot"),
        ).alias(out),
    )


def zone_map(sharded: DataFrame, columns: list[str], out: str = "shard") -> DataFrame:
    """Least and greatest value of each column in each shard, for skipping whole shards."""
    bounds = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy(F.col(out)["shard"].alias("shard")).agg(F.count(F.lit(1)).alias("rows"), *bounds)
