import os
import sys
from pathlib import Path

import pytest

os.environ["TZ"] = "UTC"

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderflow.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "orderflow-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
