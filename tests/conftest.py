from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starmart.session import build_session, checkpoint_root

    s = build_session(master="local[*]", shuffle_partitions=8)
    checkpoint_root(s)  # tests set their own only when the session has none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.exists(f"{SMOKE}/orders.parquet"):
        pytest.skip("supplied test data not present")
    return SMOKE


def rows(df, *cols):
    """Sorted tuples of the given columns (None sorts first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
