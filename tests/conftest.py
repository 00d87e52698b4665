import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from folia.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, partitions=4)
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Apply a Column function to texts and return the results in order."""
    from pyspark.sql import functions as F

    def run(function, texts):
        frame = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
        result = frame.select("i", function(F.col("text")).alias("r")).collect()
        return [row.r for row in sorted(result, key=lambda row: row.i)]

    return run
