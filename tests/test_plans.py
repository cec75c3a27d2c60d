"""The physical plans keep the properties the design relies on at scale."""

import os

import pytest

from editpulse.plans import registry
from editpulse.functions.time import minutes_before
from editpulse.plans import dashboard as dash
from editpulse.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_query_pushes_time_and_prunes_columns(spark):
    p = plan(registry.queries()["top_users"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p
    assert "TakeOrderedAndProject" in p


def test_stored_read_prunes_day_partitions(spark):
    df = registry.stored_counts(spark, SF, minutes_before(registry.AS_OF, 240))
    p = plan(dash.top_users(df, registry.AS_OF, 240))
    assert "PartitionFilters: [isnotnull(window_date" in p and "window_date" in p
    assert "GreaterThanOrEqual(window_start," in p


def test_compacted_days_read_without_shuffle_open_days_dedup_partially(spark, scratch):
    from editpulse.sinks.versioned import backfill, write_version
    from editpulse.sources.counts import read_versioned

    table = f"{scratch}/t"
    counts = registry.counts(spark, SF)
    backfill(counts, table)
    p = plan(read_versioned(spark, table))
    assert "Exchange" not in p and "Aggregate" not in p
    last_day = counts.where("window_start >= timestamp'2024-01-30 00:00:00'")
    write_version(last_day, table, 0)
    p = plan(read_versioned(spark, table))
    assert "SortAggregate" not in p
    assert "partial_max_by" in p
    assert "Union" in p
    assert read_versioned(spark, table).count() == counts.count()


def test_top_pages_limits_before_the_shuffle(spark):
    p = plan(registry.queries()["top_pages"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_counts_use_partial_aggregation(spark):
    p = plan(registry.queries()["user_edit_counts"](spark, SF))
    assert "partial_count" in p


@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if not n.startswith(("stream_", "stored_"))))
def test_no_python_udfs_or_broadcasts(spark, name):
    p = plan(registry.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "BroadcastExchange", "CartesianProduct"):
        assert bad not in p, (name, bad)


@pytest.mark.parametrize("name", ["pipeline_user_edit_counts", "pipeline_wiki_user_edit_counts",
                                  "edits_valid", "edits_rejected"])
def test_messages_are_parsed_once(spark, name):
    """Filters on parsed fields stay above the parse: one ``from_json`` per
    message, not one per filter plus one for the output."""
    p = plan(registry.queries()[name](spark, SF))
    assert p.count("from_json") == 1, name
