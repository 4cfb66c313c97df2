import shutil

import pytest

from hourgrid.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session("tests", cores="8", shuffle=4, spark__checkpoint__dir=str(shared))
    yield session
    session.stop()
    shutil.rmtree(shared, ignore_errors=True)


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema; ISO text stands for zone-less timestamps."""
    def make(data, schema, stamps=()):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(data, schema)
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df

    return make
