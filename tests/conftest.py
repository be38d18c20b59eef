import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from signalspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="signalspark-test-ckpt-")
    s = build_session("local[*]", app="signalspark-tests", shuffle_partitions=8,
                      conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
