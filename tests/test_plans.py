"""What the plans must not hold, whatever the size of the tables."""

import re

import pytest

import __spark_entry__ as E
from acopio.operators.snapshot import snapshot_delta
from acopio.sinks.tables import by_period

SF = "/root/testdata/sf0.001"
# these run several jobs of their own; their parts are covered by the others
HEAVY = {"csv_files", "json_files", "text_lines", "delimited_text", "parquet_files", "history_table", "write_audit",
         "stock_delta_table", "stock_and_its_history", "replace_by_condition", "file_feed", "flow_in_rounds", "landed_files",
         "landed_bytes", "landed_again", "gzip_landed", "walked_tree", "files_with_errors", "history_by_condition", "history_by_range",
         "stock_delta_repeated", "audit_fields", "many_targets", "history_in_waves", "feed_through_writer", "feed_archived",
         "json_mixed_types", "json_dialects", "clashing_columns", "step_log"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - HEAVY))
def test_no_pairs_and_no_row_udfs(spark, name):
    text = plan(E.queries()[name](spark, SF))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", text)


def test_scans_read_only_what_is_needed(spark):
    text = plan(E.queries()["file_types"](spark, SF))
    assert "text" not in re.search(r"ReadSchema: (\S+)", text).group(1)
    text = plan(E.queries()["landing_decision"](spark, SF))
    assert not re.search(r"ReadSchema: struct<[^>]*text:", text)


def test_snapshot_without_broadcast_shuffles_by_key(spark):
    frame = lambda n: spark.range(n).selectExpr("id AS SDELTA_ID", "md5(cast(id AS string)) AS ingesta_md5", "id AS v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delta = snapshot_delta(frame(100), frame(90))
        text = plan(delta)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
        assert delta.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_partitioned_writes_rebalance(spark):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(by_period(spark.range(10).selectExpr("id", "id % 2 AS periodo")))
