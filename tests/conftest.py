import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cartograin.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    saved = {}

    def change(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in saved.items():
        spark.conf.set(name, value)


@pytest.fixture
def spread(settings):
    """Small data in many partitions, and no broadcast joins."""
    settings(adaptive__coalescePartitions__enabled="false", autoBroadcastJoinThreshold="-1")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
