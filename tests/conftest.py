import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skylake.session import build_session, remove_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.checkpoint.dir": str(base / "shared"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_scratch(session)
    session.stop()


@pytest.fixture
def plan():
    def text(df) -> str:
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
