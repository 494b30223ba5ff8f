import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from lectern.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.lectern.spread": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Value of a column expression over one string cell named ``x``."""

    def run(expr, value, schema="x string"):
        return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]

    return run
