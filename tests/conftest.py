import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lakeshore.session import get_session
    s = get_session("local[4]", app="lakeshore-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from lakeshore.session import scratch_dir
    return scratch_dir(spark, "test")
