import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from seqloom.session import local_session  # noqa: E402

DATA = os.environ.get("SEQLOOM_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA


@pytest.fixture
def seq(spark):
    """Build a sequence (or grouped sequences) from Python values."""

    def build(values, kind="int", name="v"):
        rows = [(i, v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, f"_pos LONG, {name} {kind}")

    return build


def in_order(df, name="v"):
    """The values of a sequence, checking that its positions are dense."""
    rows = df.orderBy("_pos").collect()
    assert [r["_pos"] for r in rows] == list(range(len(rows)))
    return [r[name] for r in rows]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
