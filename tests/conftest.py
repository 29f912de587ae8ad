import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from oeeflow.session import get_session
    s = get_session("local[4]", 4, driver_memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def wo(spark):
    from oeeflow.session import materialize
    from oeeflow.sources.fixture import work_orders
    return materialize(work_orders(spark, SF_SMALL))
