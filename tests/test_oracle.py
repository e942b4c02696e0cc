"""Every query against its SQL on the smallest tables."""

import pytest
from tables import SMALL
from oracle_check import compare, connect

from noticeflow.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        assert compare(frame, con, ORACLES[name]) is None
    else:
        assert frame.count() > 0


KEYED = ["classify_batch", "existing_with_doc", "state_lookup", "update_changed", "resolve_pending"]


@pytest.mark.parametrize("name", KEYED)
def test_query_with_split_keys(spark, con, name, join_path):
    if join_path == "spread":
        assert compare(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None
