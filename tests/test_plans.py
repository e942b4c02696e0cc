"""Plans: pushed filters, pruned columns, no Python, no cross joins."""

import pytest
from tables import SMALL

from noticeflow.catalog import QUERIES, inputs
from noticeflow.operators.skew import Sized, keyed_join


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


TEXT = [n for n in QUERIES if n.startswith("clean_") or n in (
    "accent_fold", "join_lines", "strip_legal_form", "split_legal_form", "html_rows",
    "classify_batch", "semi_independent", "anti_independent", "pattern_join_files_prefix",
    "names_present", "run_incremental", "update_changed", "resolve_pending",
)]


@pytest.mark.parametrize("name", TEXT)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "NestedLoop"):
        assert bad not in text


def test_filters_reach_the_scan(spark):
    assert "GreaterThanOrEqual(o_orderdate" in plan(QUERIES["incremental_filter"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in plan(QUERIES["changed_since"](spark, SMALL))
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan(inputs.registry(spark, SMALL))


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["incremental_filter"](spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_size_decides_between_broadcast_and_shuffle(spark):
    left = inputs.staged(spark, SMALL)
    right = left.select("Codigo").distinct()
    small = plan(keyed_join(left, Sized(right), ["Codigo"], "left_semi"))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    for limit in ("Rows", "Bytes"):
        spark.conf.set(f"spark.noticeflow.broadcast{limit}", "100")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = plan(keyed_join(left, Sized(right), ["Codigo"], "left_semi"))
        spark.conf.unset(f"spark.noticeflow.broadcast{limit}")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "SortMergeJoin" in large or "ShuffledHashJoin" in large


def test_updates_combine_before_the_shuffle(spark):
    from noticeflow.operators.updates import last_update

    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    text = plan(last_update(lines, ["l_orderkey"], ["l_linenumber"]))
    assert "partial_max" in text and text.count("Exchange") <= 4
