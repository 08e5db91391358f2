import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from basketry.session import get_session
    return get_session(master="local[*]", shuffle_partitions=8)


@pytest.fixture(scope="session")
def inputs(spark):
    from basketry.plans.registry import Inputs
    return Inputs(spark, SF_SMALL)
