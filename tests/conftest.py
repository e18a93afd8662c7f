import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from parcorpus.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as tuples (test helper only, small frames)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
