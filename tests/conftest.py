import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from pasarlens.session import build_session

    session = build_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def json_records(spark):
    """Make a ``record`` column from JSON texts."""
    from pyspark.sql import functions as F

    def make(*texts: str):
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        return df.select(F.explode(F.array(F.parse_json("text"))).alias("record"))

    return make
