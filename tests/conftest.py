import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulse.session import get_spark  # noqa: E402

SF_DIR = os.environ.get("PULSE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "pulse-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
