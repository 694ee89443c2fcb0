import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from martlake.session import build_session
    s = build_session("local[4]", app_name="martlake-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="martlake-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    from martlake.session import scratch_path
    return scratch_path(spark, "test")
