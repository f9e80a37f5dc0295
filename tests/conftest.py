import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    """A skewed corpus: one class is a fifth of the rows, and a third of the texts are one text."""
    rows = [
        (i, "the same text again and again, it is." if i % 3 == 0 else f"text number {i} is listed.", int(i % 5 == 0))
        for i in range(1000)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(8)
