import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session(
        "tests", "local[8]", **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate columns over one row and return the values."""
    from pyspark.sql import functions as F

    def run(*cols):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
        return row[0] if len(cols) == 1 else tuple(row)

    run.F = F
    return run
