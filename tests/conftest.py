import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from socialog.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8,
        **{"spark.sql.shuffle.partitions": "4", "spark.sql.maxMetadataStringLength": "4000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield lambda mapping: change(**mapping)
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def many_tasks(settings):
    """Keep small shuffles in all their tasks."""
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"})


def final_plan(df) -> str:
    """The physical plan after adaptive execution has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
