import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hearthmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column expression on a list of values."""

    def evaluate(expression, cells, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(cells)), f"i int, v {kind}")
        return [r[0] for r in rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").select("r").collect()]

    return evaluate
