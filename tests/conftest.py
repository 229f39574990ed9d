import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from surveylake.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4,
                  extra={"spark.ui.showConsoleProgress": "false",
                         "spark.sql.sources.partitionOverwriteMode": "static"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp(spark):
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="surveylake-test-")


SF = "/root/testdata/sf0.001"
