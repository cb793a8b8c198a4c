import datetime
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortair.sources.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def day(text):
    return None if text is None else datetime.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples, missing values first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])
