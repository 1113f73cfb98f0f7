import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termpulse.session import make_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = make_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to a list of strings and return the list of results."""
    from pyspark.sql import functions as F

    def apply(function, values, *names):
        if not names:
            df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
            result = df.select("i", function(F.col("v")).alias("r"))
        else:
            schema = "i int, " + ", ".join(f"{n} string" for n in names)
            df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], schema)
            result = df.select("i", function(*[F.col(n) for n in names]).alias("r"))
        return [r.r for r in sorted(result.collect(), key=lambda r: r.i)]

    return apply
