import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("local[*]", shuffle_partitions=8, app="tessera-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables not available")
    return SF_SMALL


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
