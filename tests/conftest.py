import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from beatline.session import local_session
    s = local_session(4, shuffle_partitions=4, app="beatline-tests")
    yield s
    s.stop()


def physical_plan(df) -> str:
    """Formatted physical plan text (after adaptive planning when executed)."""
    return df._jdf.queryExecution().executedPlan().toString()
