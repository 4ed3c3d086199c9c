import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from meterbill.session import get_spark
    # the checkpoint folder comes from the session configuration; get_spark
    # only falls back to a local one when none is configured
    s = get_spark("local[*]", app="meterbill-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from meterbill.session import scratch_path
    return lambda name: scratch_path(spark, name)
