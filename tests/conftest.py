import contextlib

import pytest

from airway.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Run with broadcasting switched off, as for lookups beyond the bound."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    with contextlib.ExitStack() as stack:
        stack.callback(spark.conf.set, key, before)
        yield
