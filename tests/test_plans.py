"""Physical plans of the registered queries."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TRAINING = {"gbt_rule", "gbt_predictions", "gbt_metrics", "model_roundtrip", "job_outputs"}
QUERIES = {
    name: query
    for name, query in entry_module.queries().items()
    if name not in TRAINING and name != "pipeline" and not re.match(r"op\d+_", name)
}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(query(spark, SF_DIR)) for name, query in QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(plans, name):
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plans[name]


@pytest.mark.parametrize(
    ("name", "read"),
    [
        ("numeric_range", "struct<o_totalprice:double>"),
        ("numeric_range_all", "struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>"),
        ("date_parts_basic", "struct<event_id:bigint,ts:timestamp_ntz>"),
        ("split_keyed", "struct<o_orderkey:bigint>"),
        ("confusion_counts", "struct<o_totalprice:double,o_orderpriority:string>"),
        ("bucketize", "struct<event_id:bigint,value:double>"),
        ("string_index", "struct<o_orderkey:bigint,o_orderpriority:string>"),
    ],
)
def test_only_the_needed_columns_are_read(plans, name, read):
    assert f"ReadSchema: {read}" in plans[name]


@pytest.mark.parametrize(
    "name",
    [
        "decimal_to_double", "label_cast", "string_to_timestamp", "date_parts_basic", "date_parts_extended",
        "date_parts_all", "quarter_variants", "week_number_iso", "week_number_us", "split_keyed", "bucketize",
        "bucketize_stage", "string_index_stage", "one_hot_stage", "assemble_features", "feature_frame",
        "feature_frame_calendar", "prediction_target", "hold_out",
    ],
)
def test_row_by_row_operators_do_not_shuffle(plans, name):
    """But for rank tables, which are broadcast after their size is measured."""
    for way in ("hashpartitioning", "rangepartitioning", "SinglePartition", "RoundRobin"):
        assert way not in plans[name]


@pytest.mark.parametrize("name", ["numeric_range", "numeric_range_all", "confusion_counts", "classification_metrics"])
def test_global_aggregates_exchange_one_row_per_task(plans, name):
    assert plans[name].count("Exchange SinglePartition") == 1
    assert "partial_" in plans[name]


def test_small_ranks_are_broadcast(plans):
    assert "BroadcastHashJoin" in plans["string_index"]
    assert "SortMergeJoin" not in plans["string_index"]


@pytest.mark.parametrize("name", ["string_index_shuffled", "string_index_skewed"])
def test_settled_rows_are_not_shuffled_to_large_ranks(no_auto_broadcast, name):
    plan = _plan(QUERIES[name](no_auto_broadcast, SF_DIR))
    settled = plan.split("Union", 1)[1].split("BroadcastExchange", 1)[0]
    assert "FileScan parquet" in settled and "BroadcastHashJoin" in settled
    assert "Exchange" not in settled and "SortMergeJoin" not in settled
    rest = plan.split("Union", 1)[1].split("\n   +- ", 1)[1]
    assert rest.split("BroadcastExchange", 1)[0].count("SortMergeJoin") == 1
