import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4, app_name="ledgerlens-tests",
                  extra={"spark.driver.memory": "8g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ll-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ll-test-")


@pytest.fixture(scope="session")
def small_pipeline(spark):
    from ledgerlens.queries import pipeline
    return pipeline(spark, SF_SMALL)


def rows(df, *cols):
    """Collect as sorted list of tuples over ``cols`` (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
