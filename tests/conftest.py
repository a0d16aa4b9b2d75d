import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from fixtures import FEEDBACK, MOVIES, RATINGS  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("palate-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "userId INT, movieId INT, rating DOUBLE")


@pytest.fixture(scope="session")
def movies(spark):
    return spark.createDataFrame(MOVIES, "movieId INT, title STRING, genres STRING")


@pytest.fixture(scope="session")
def feedback(spark):
    return spark.createDataFrame(FEEDBACK, "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT")
