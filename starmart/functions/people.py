"""Derived person measures: age, age band, new hire, separation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AGE_BANDS, DAYS_PER_YEAR


def as_of_column(as_of: dt.date | str | None) -> Column:
    """The run date: a fixed date for repeatable runs, else today."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def age(date_of_birth: Column | str, as_of: dt.date | str | None = None) -> Column:
    """Age in years as a double, counting 365 days per year."""
    return F.datediff(as_of_column(as_of), F.col(date_of_birth) if isinstance(date_of_birth, str) else date_of_birth) / F.lit(
        DAYS_PER_YEAR
    )


def age_band(age_col: Column | str) -> Column:
    """Band label of an age; the age is truncated to whole years first.

    Under 18, and unknown ages, give null.
    """
    years = (F.col(age_col) if isinstance(age_col, str) else age_col).cast("int")
    expr = None
    for label, low, high in AGE_BANDS:
        cond = years >= low if high is None else years.between(low, high)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def on_day(date_col: Column | str, as_of: dt.date | str | None = None) -> Column:
    """1 when the date is the run date, else 0 (null dates give 0)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.when(c == as_of_column(as_of), F.lit(1)).otherwise(F.lit(0))
