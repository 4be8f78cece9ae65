import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickflow.session import build_session
    s = build_session("tickflow-tests", "local[*]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g"})
    # tests set their own shared folder only because none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_stays_cached():
    """What a module's tests cache is gone for the next module."""
    yield
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    if s is not None:
        s.catalog.clearCache()
