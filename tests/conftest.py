import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sensorflow.session import get_session
    s = get_session("local[*]", 8, app_name="sensorflow-tests",
                    extra={"spark.ui.showConsoleProgress": "false", "spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_shared(spark):
    """A fresh folder below the session's checkpoint root (never cleared with rm)."""
    from sensorflow.session import scratch_dir
    return lambda name: scratch_dir(spark, name)


SF_SMALL = "/root/testdata/sf0.001"
