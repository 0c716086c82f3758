import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from basketlab.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", shuffle_partitions=4, driver_memory="6g")
    # plan texts are searched for whole paths, also long ones
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Joins must also be right when nothing is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
