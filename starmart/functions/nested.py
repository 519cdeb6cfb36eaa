"""Nested-field access that is safe on empty or null arrays under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_location(col: str = "work_location") -> Column:
    # F.get returns null for an out-of-range index; plain [0] fails under ANSI.
    return F.get(F.col(col), F.lit(0))


def first_location_country(col: str = "work_location") -> Column:
    return first_location(col).getField("country").getField("name")


def first_location_code(col: str = "work_location") -> Column:
    return first_location(col).getField("code")


def last_manager_email(col: str = "managers_hierarchy") -> Column:
    """Email of the direct manager: the last hierarchy entry; null if none."""
    return F.try_element_at(F.col(col), F.lit(-1)).getField("email")
