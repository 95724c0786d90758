import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickerflow.session import get_spark

    s = get_spark("local[4]", 4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tf-test-ckpt-")})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
