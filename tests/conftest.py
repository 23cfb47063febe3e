import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("starmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Session settings for the length of one test."""

    changed = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@contextmanager
def failing(text):
    """The block must stop with a Spark error that mentions ``text``."""
    with pytest.raises(Exception) as caught:
        yield
    assert text in str(caught.value), str(caught.value)[:2000]
