import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import CLASHING, ODD_ROWS, SCHEMA, SF_DIR  # noqa: E402
@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with columns of other meaning whose names clash with those of results."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD_ROWS, SCHEMA)
    return rows.select("*", *[F.lit("other").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
