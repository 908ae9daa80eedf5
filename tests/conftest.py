from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martkit.session import local_session

    return local_session(4, "martkit-tests")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def no_broadcast(spark):
    """A session in which nothing is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
