import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ontime_spark.session import get_spark
    # The library never makes up a folder for intermediates: the session names one.
    s = get_spark("ontime_spark_tests", master="local[4]", shuffle_partitions=4,
                  conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"),
                        "spark.driver.memory": "4g"})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ontime-test-", dir="/tmp")
