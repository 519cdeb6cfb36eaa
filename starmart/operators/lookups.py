"""Dimension lookups: attach surrogate keys to the people frame.

A dimension whose row count the caller knows to be small is broadcast; any other
is left to Spark, which broadcasts it at run time if its measured size allows
and else joins by shuffle, splitting skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BROADCAST_MAX_ROWS
from ..functions.keys import fold


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when ``rows``, a count the caller knows, is under the bound, else ``df``."""
    return F.broadcast(df) if rows is not None and rows <= max_rows else df


def lookup_side(dim: DataFrame, key: str, attrs: Sequence[str], names: Sequence[str], folded: bool, unique: bool = False) -> DataFrame:
    """``key`` and the match values under ``names``.

    Folded: one row per folded value with its smallest key, so a table that holds
    several spellings of a member matches each person once. A table that is known
    to be ``unique`` has one row already and is not aggregated.
    """
    f = fold if folded else (lambda c: c)
    side = dim.select(F.col(key), *[f(F.col(a)).alias(t) for a, t in zip(attrs, names)])
    return side.groupBy(*names).agg(F.min(key).alias(key)) if folded and not unique else side


def lookup(
    people: DataFrame,
    dim: DataFrame,
    key: str,
    people_cols: Sequence[Column],
    dim_attrs: Sequence[str],
    folded: bool = True,
    max_rows: int = BROADCAST_MAX_ROWS,
    rows: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Inner null-safe equi-join adding ``key``; people without a member drop out.

    ``folded`` compares lower-cased values on both sides (the merge's notion of
    a member); otherwise values compare exactly. Only the key survives from the
    dimension, so repeated lookups do not pile up same-named columns.
    """
    f = fold if folded else (lambda c: c)
    tmp = [f"_lk_{i}" for i in range(len(dim_attrs))]
    right = lookup_side(dim, key, dim_attrs, tmp, folded, unique)
    left_tmp = [f"_lv_{i}" for i in range(len(dim_attrs))]
    left = people.withColumns({t: f(c) for t, c in zip(left_tmp, people_cols)})
    cond = [left[lt].eqNullSafe(right[rt]) for lt, rt in zip(left_tmp, tmp)]
    joined = left.join(broadcast_checked(right, max_rows, rows), cond, "inner")
    return joined.drop(*left_tmp, *tmp)


def lookup_many(people: DataFrame, steps: Sequence[tuple], max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Several lookups with one projection for all probe keys and one for the result.

    ``steps``: (dim frame, key, people columns, dimension attributes, folded, rows
    or None, unique). Same result as chained :func:`lookup` calls, with a shorter plan.
    """
    probes = {}
    joins = []
    for n, (dim, key, people_cols, dim_attrs, folded, rows, unique) in enumerate(steps):
        f = fold if folded else (lambda c: c)
        lv = [f"_lv{n}_{i}" for i in range(len(dim_attrs))]
        lk = [f"_lk{n}_{i}" for i in range(len(dim_attrs))]
        probes.update({t: f(c) for t, c in zip(lv, people_cols)})
        right = lookup_side(dim, key, dim_attrs, lk, folded, unique)
        joins.append((broadcast_checked(right, max_rows, rows), lv, lk))
    out = people.select("*", *[c.alias(t) for t, c in probes.items()])
    temps = list(probes)
    for right, lv, lk in joins:
        out = out.join(right, [out[a].eqNullSafe(right[b]) for a, b in zip(lv, lk)], "inner")
        temps += lk
    return out.drop(*temps)
