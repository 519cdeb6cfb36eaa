"""Partition parts of run-history data paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def path_part(path: Column | str, part: str, compat: bool = False) -> Column:
    """Value of ``part=<digits>`` in a directory path.

    Default: the digits wherever they stand (also at the end of the path), as an
    int; no match gives null. ``compat``: the digits must be followed by one more
    character, the value stays a string, and no match gives ``''`` (so
    ``hour=7`` at the end of a path is ``''`` and ``hour=12`` is ``'1'``).
    """
    c = F.col(path) if isinstance(path, str) else path
    if compat:
        return F.regexp_extract(c, part + config.COMPAT_PATH_PART, 1)
    return F.regexp_extract(c, part + r"=(\d+)", 1).try_cast("int")


_WATERMARK = re.compile(r"year=(\d+)[^\d\s]month=(\d+)[^\d\s]day=(\d+)")


def parse_watermark(path: str, compat: bool = False) -> tuple[str, str, str]:
    """(year, month, day) strings of the last loaded path; exactly one match.

    Default: the whole day, also at the end of the path. ``compat``: the day must
    be followed by one more character, so ``day=15`` at the end gives day ``1``.
    """
    found = (re.compile(config.COMPAT_WATERMARK) if compat else _WATERMARK).findall(path)
    if len(found) != 1:
        raise ValueError(f"no single year/month/day in the path: {path}")
    return found[0]
