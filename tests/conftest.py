import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from dqflow.session import build_session

    s = build_session("local[4]", app_name="dqflow-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def no_frames_stay_cached(spark):
    """Frames that a module's tests cache are no concern of the next module."""
    yield
    spark.catalog.clearCache()
