import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from reelcat.session import local_session

    s = local_session("*", shuffle_partitions=8, app="reelcat-tests")
    yield s


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
