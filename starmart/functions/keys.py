"""Null-safe, optionally case-folded key comparison."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(c: Column | str) -> Column:
    return F.lower(F.col(c) if isinstance(c, str) else c)


def null_safe_match(left: Sequence[Column], right: Sequence[Column], folded: bool = True) -> Column:
    """AND of ``l <=> r`` over column pairs; ``folded`` compares lower-cased values.

    Null equals null, so a null attribute is a real dimension member. Spark plans
    ``<=>`` as an equi-join key (hash / sort-merge / broadcast), never a nested loop.
    """
    if len(left) != len(right) or not left:
        raise ValueError("need the same, non-zero number of columns on both sides")
    f = fold if folded else (lambda c: c)
    return functools.reduce(operator.and_, [f(a).eqNullSafe(f(b)) for a, b in zip(left, right)])
