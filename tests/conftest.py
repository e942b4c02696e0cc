import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from noticeflow.session import local_session  # noqa: E402


# Test modules build columns when they are imported, which needs a session.
SPARK = local_session(4, partitions=4, app="tests")


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture(params=["broadcast", "spread"])
def join_path(request, spark):
    """Run a test by way of broadcast joins and by way of split hot keys."""
    if request.param == "spread":
        spark.conf.set("spark.noticeflow.broadcastRows", "0")
        spark.conf.set("spark.noticeflow.hotRows", "3")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    for key in ("spark.noticeflow.broadcastRows", "spark.noticeflow.hotRows"):
        spark.conf.unset(key)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def evaluate(spark):
    """Values of column expressions over text rows."""

    def run(texts, *columns):
        rows = [(i, t) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, "i int, t string")
        named = [c.alias(f"c{n}") for n, c in enumerate(columns)]
        out = sorted(frame.select("i", *named).collect())
        return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in out]

    return run
