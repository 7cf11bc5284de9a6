import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
for folder in (HERE, os.path.dirname(HERE)):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from brindle.session import local_session  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "brindle-tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def rows(spark):
    """Small frames from literals."""

    def make(data, schema, partitions=None):
        df = spark.createDataFrame(data, schema)
        return df.repartition(partitions) if partitions else df

    return make
