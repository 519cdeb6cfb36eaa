"""Row filters on the people frame."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ASSIGNMENT_STATUSES, DENIED_PERSON_TYPES, WORKER_TYPES
from .rules import Rule, filter_rule


def is_active() -> Column:
    """``is_active = true``: null and false are both dropped."""
    return F.col("is_active") == F.lit(True)


def allowed(col: str, values: Iterable[str]) -> Column:
    """Case-insensitive allow-list; null is dropped."""
    return F.lower(F.col(col)).isin([v.lower() for v in values])


def not_denied(col: str, values: Iterable[str]) -> Column:
    """Case-insensitive deny-list. Null is dropped too (NOT of null is null)."""
    return ~F.lower(F.col(col)).isin([v.lower() for v in values])


def active_people() -> Rule:
    return filter_rule(is_active())


def allowed_assignment_status() -> Rule:
    return filter_rule(allowed("assignment_status", ASSIGNMENT_STATUSES))


def allowed_worker_type() -> Rule:
    return filter_rule(allowed("worker_type", WORKER_TYPES))


def not_denied_person_type(col: str = "user_type") -> Column:
    return not_denied(col, DENIED_PERSON_TYPES)


def fact_filters() -> list[Rule]:
    """The three filters both facts apply, in order."""
    return [active_people(), allowed_assignment_status(), allowed_worker_type()]
