import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import get_session
    s = get_session("local[4]", app="tripmart-tests", shuffle_partitions=8,
                    **{"spark.driver.memory": "4g",
                       "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tripmart-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tripmart-test-")
