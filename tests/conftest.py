import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from subrev.session import BUILD_CONF, tune  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config(map=BUILD_CONF).config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def make(spark):
    """Text table from rows of a spec: ``make(spec, {"col": value}, ...)``; columns left out are null."""
    def build(spec, *rows):
        data = [tuple(r.get(c) for c in spec.columns) for r in rows]
        return spark.createDataFrame(data, spec.raw_schema)
    return build


def by_key(df, key):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
