import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from pulse.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("pulse-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
