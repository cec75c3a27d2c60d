import datetime as dt

import pytest

from collected import rows
from editpulse.config import WindowSpec
from editpulse.functions.parse import parse_edits
from editpulse.operators.latest import latest_version
from editpulse.operators.windowed import count_table, user_edit_counts
from editpulse.plans import dashboard as dash

B = 1700000040  # a minute boundary


def edits(spark, triples):
    """(user, title, seconds) -> parsed edits."""
    import json

    vals = [(json.dumps({"id": str(i), "title": t, "user": u, "type": "edit", "namespace": 0,
                         "timestamp": s}),) for i, (u, t, s) in enumerate(triples)]
    return parse_edits(spark.createDataFrame(vals, "value string"))


def utc(secs):
    return dt.datetime.fromtimestamp(secs, dt.timezone.utc).replace(tzinfo=None)


def test_window_edges_half_open(spark):
    e = edits(spark, [("a", "P", B), ("a", "P", B + 59), ("a", "P", B + 60)])
    out = user_edit_counts(e, WindowSpec("1 minute"))
    got = [(r.window_start, r.window_end, r.user_name, r.edit_count)
           for r in out.orderBy("window_start").collect()]
    starts = [int(r[0].timestamp()) for r in got]
    assert starts == [B, B + 60]
    assert [r[3] for r in got] == [2, 1]
    assert all(int(r[1].timestamp()) - int(r[0].timestamp()) == 60 for r in got)


def test_sliding_windows_count_each_event_twice(spark):
    e = edits(spark, [("a", "P", B + 10)])
    out = user_edit_counts(e, WindowSpec("2 minutes", "1 minute")).collect()
    assert sorted(int(r.window_start.timestamp()) for r in out) == [B - 60, B]


def test_null_user_is_not_counted(spark):
    e = edits(spark, [(None, "P", B), ("a", "P", B)])
    assert rows(user_edit_counts(e, WindowSpec("1 minute")), "user_name", "edit_count") == [("a", 1)]


def _counts(spark, data):
    """data: (window_start_secs, user, count) with 1-minute windows."""
    return spark.createDataFrame(
        [(utc(s), utc(s + 60), u, c) for s, u, c in data],
        "window_start timestamp, window_end timestamp, user_name string, edit_count bigint",
    )


def test_range_edge_is_inclusive(spark):
    as_of = B + 600
    c = _counts(spark, [(B, "a", 1), (B - 60, "b", 1)])
    out = dash.recent_user_edit_counts(c, as_of, 10)
    assert [r.user_name for r in out.collect()] == ["a"]


def test_statistics_empty_range_one_row(spark):
    c = _counts(spark, [(B, "a", 3)])
    r = dash.statistics(c, B + 10 * 86400).collect()
    assert len(r) == 1
    assert (r[0].unique_users, r[0].total_edits, r[0].avg_edits_per_window,
            r[0].max_edits_single_window) == (0, None, None, None)


def test_statistics_values(spark):
    c = _counts(spark, [(B, "a", 3), (B + 60, "a", 1), (B, "b", 2)])
    r = dash.statistics(c, B + 120).collect()[0]
    assert (r.unique_users, r.total_edits, r.max_edits_single_window) == (2, 6, 3)
    assert r.avg_edits_per_window == pytest.approx(2.0)


def test_top_users_ties_by_name(spark):
    c = _counts(spark, [(B, "b", 2), (B, "a", 2), (B, "c", 1), (B + 60, "c", 1), (B, "d", 1)])
    out = dash.top_users(c, B + 120, 60, limit=3).collect()
    assert [(r.user_name, r.total_edits) for r in out] == [("a", 2), ("b", 2), ("c", 2)]


def test_high_volume_editors_order(spark):
    c = _counts(spark, [(B, "a", 5), (B + 60, "b", 5), (B, "c", 1)])
    out = dash.high_volume_editors(c, B + 120, 60, limit=2).collect()
    assert [r.user_name for r in out] == ["b", "a"]
    assert out[0].asDict().keys() == {"user_name", "edit_count", "window_start"}


def test_timeline_and_windows(spark):
    c = _counts(spark, [(B, "a", 1), (B, "b", 2), (B + 60, "a", 4)])
    asc = dash.edit_timeline(c, B + 120, 60).collect()
    assert [r.total_edits for r in asc] == [3, 4]
    desc = dash.edit_timeline(c, B + 120, 60, descending=True).collect()
    assert [r.total_edits for r in desc] == [4, 3]
    w = dash.recent_windows(c, 1).collect()
    assert int(w[0].window_start.timestamp()) == B + 60


def test_today_uses_midnight(spark):
    midnight = B - B % 86400
    c = _counts(spark, [(midnight, "a", 1), (midnight - 60, "b", 9)])
    out = dash.top_contributors_today(c, midnight + 3600).collect()
    assert [(r.user_name, r.total) for r in out] == [("a", 1)]


def test_top_pages_per_window(spark):
    e = edits(spark, [("u", "P1", B), ("u", "P1", B + 1), ("u", "P2", B + 2), ("u", "P3", B + 3),
                      ("u", "P9", B + 60)])
    pages = count_table(e, "top_pages", WindowSpec("1 minute"))
    out = dash.top_pages(pages, 2).orderBy("window_start", "page_rank").collect()
    assert [(r.page_title, r.edit_count, r.page_rank) for r in out] == [
        ("P1", 2, 1), ("P2", 1, 2), ("P9", 1, 1)]


def test_latest_version_picks_highest(spark):
    df = spark.createDataFrame(
        [("k", 0, 1), ("k", 2, 3), ("k", 1, 2), ("j", 5, 7)], "key string, v long, n long")
    out = latest_version(df, ["key"], "v", ["n"])
    assert rows(out) == [("j", 7), ("k", 3)]


def test_retention_keep(spark):
    c = _counts(spark, [(B, "a", 1), (B - 86400 * 8, "b", 1)])
    assert [r.user_name for r in dash.retention_keep(c, B + 60, 7).collect()] == ["a"]


def test_recent_counts_with_created_at(spark):
    from pyspark.sql import functions as F

    c = _counts(spark, [(B, "a", 1)]).withColumn("created_at", F.current_timestamp())
    out = dash.recent_user_edit_counts(c, B + 60, 10, with_created_at=True)
    assert out.columns[-1] == "created_at"
    assert dash.edit_timeline(c, B + 60, 10, value_name="edits").columns == ["window_start", "edits"]
