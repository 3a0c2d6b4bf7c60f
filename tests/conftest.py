import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lodestone.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8, app="lodestone-tests",
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lodestone-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from lodestone.session import work_dir
    return work_dir(spark, "test")
