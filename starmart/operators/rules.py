"""Rules: plain ``DataFrame -> DataFrame`` callables, composed with ``transform``.

A unary rule defaults to identity; a binary rule (frame, other) defaults to the
left frame. Aggregation is a rule like any other, so a fact is just a list.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame

Rule = Callable[[DataFrame], DataFrame]
BinaryRule = Callable[[DataFrame, DataFrame], DataFrame]


def no_rule(df: DataFrame) -> DataFrame:
    return df


def keep_left(left: DataFrame, right: DataFrame) -> DataFrame:  # noqa: ARG001
    return left


def filter_rule(condition: Column) -> Rule:
    def apply(df: DataFrame) -> DataFrame:
        return df.filter(condition)

    return apply


def aggregation(keys: Sequence[str | Column], first: Column, *more: Column) -> Rule:
    """Group by ``keys`` and compute at least one aggregate (partial + final in Spark)."""

    def apply(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(first, *more)

    return apply


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Apply the rules in order (a left fold with ``DataFrame.transform``)."""
    return functools.reduce(lambda acc, rule: acc.transform(rule), rules, df)
