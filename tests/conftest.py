import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

# Workers import the package and the tests' modules by name.
os.environ["PYTHONPATH"] = os.pathsep.join([*sys.path[:2], os.environ.get("PYTHONPATH", "")])

from outpulse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "outpulse-tests", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a Column built from plain Python values."""

    def value(column, schema="x INT", row=(0,)):
        return spark.createDataFrame([row], schema).select(column.alias("v")).first().v

    return value


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
