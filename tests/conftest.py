import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", "tests", **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def column(spark):
    """Values of a column expression over one column ``text``."""

    def run(expression, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
        return [r["o"] for r in df.select("i", expression.alias("o")).orderBy("i").collect()]

    return run
