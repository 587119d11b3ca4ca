import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from tidemark.session import configured

    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = configured(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Build a daily frame from {key: [values]} (one value per day from 2023-01-01)."""
    import datetime

    def build(values, first="2023-01-01", kind="double"):
        start = datetime.date.fromisoformat(first)
        rows = [
            (k, start + datetime.timedelta(days=i), None if v is None else float(v))
            for k, vs in values.items()
            for i, v in enumerate(vs)
        ]
        return spark.createDataFrame(rows, f"series_key string, day date, value {kind}")

    return build


@pytest.fixture(scope="session")
def column():
    """The values of one column in (key, day) order."""

    def read(df, name, *order):
        return [r[0] for r in df.orderBy(*(order or ("series_key", "day"))).select(name).collect()]

    return read
