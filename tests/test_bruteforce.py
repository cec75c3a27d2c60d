"""Random small edit sets: Spark operators equal a plain-Python brute force."""

import json
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from editpulse.config import WindowSpec
from editpulse.functions.parse import parse_edits
from editpulse.operators.windowed import count_table
from editpulse.plans import dashboard as dash

B = 1700000040
USERS = ["a", "b", "c", "d"]
PAGES = ["P1", "P2", "P3"]

events_st = st.lists(
    st.tuples(st.sampled_from(USERS), st.sampled_from(PAGES), st.integers(0, 600)),
    min_size=1, max_size=40,
)

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def parsed(spark, events):
    vals = [(json.dumps({"id": str(i), "title": p, "user": u, "type": "edit", "namespace": 0,
                         "timestamp": B + s}),) for i, (u, p, s) in enumerate(events)]
    return parse_edits(spark.createDataFrame(vals, "value string"))


def brute_windows(events, size, step, key_index):
    out = Counter()
    for ev in events:
        t = B + ev[2]
        last = t - t % step
        start = last
        while start > t - size:
            out[(start, ev[key_index])] += 1
            start -= step
    return out


@SETTINGS
@given(events=events_st)
def test_tumbling_and_sliding_counts(spark, events):
    df = parsed(spark, events)
    for spec, size, step in ((WindowSpec("1 minute"), 60, 60),
                             (WindowSpec("2 minutes", "1 minute"), 120, 60)):
        got = {(int(r.window_start.timestamp()), r.user_name): r.edit_count
               for r in count_table(df, "user_edit_counts", spec).collect()}
        assert got == dict(brute_windows(events, size, step, 0))


@SETTINGS
@given(events=events_st, minutes=st.integers(0, 12), k=st.integers(1, 4))
def test_dashboard_aggregates(spark, events, minutes, k):
    counts = count_table(parsed(spark, events), "user_edit_counts", WindowSpec("1 minute"))
    as_of = B + 600
    bound = as_of - minutes * 60
    rows = [(s, u, c) for (s, u), c in brute_windows(events, 60, 60, 0).items() if s >= bound]

    totals = defaultdict(int)
    for _, u, c in rows:
        totals[u] += c
    want_top = sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:k]
    got_top = [(r.user_name, r.total_edits) for r in dash.top_users(counts, as_of, minutes, k).collect()]
    assert got_top == want_top

    s = dash.statistics(counts, as_of, minutes).collect()[0]
    assert s.unique_users == len(totals)
    assert s.total_edits == (sum(totals.values()) if rows else None)
    assert s.max_edits_single_window == (max(c for _, _, c in rows) if rows else None)

    timeline = defaultdict(int)
    for st_, _, c in rows:
        timeline[st_] += c
    got_tl = [(int(r.window_start.timestamp()), r.total_edits)
              for r in dash.edit_timeline(counts, as_of, minutes).collect()]
    assert got_tl == sorted(timeline.items())


@SETTINGS
@given(events=events_st, k=st.integers(1, 3))
def test_top_pages_per_window(spark, events, k):
    pages = count_table(parsed(spark, events), "top_pages", WindowSpec("2 minutes"))
    got = sorted((int(r.window_start.timestamp()), r.page_rank, r.page_title, r.edit_count)
                 for r in dash.top_pages(pages, k).collect())
    per_window = defaultdict(list)
    for (s, p), c in brute_windows(events, 120, 120, 1).items():
        per_window[s].append((p, c))
    want = []
    for s, items in per_window.items():
        ranked = sorted(items, key=lambda x: (-x[1], x[0]))[:k]
        want += [(s, i + 1, p, c) for i, (p, c) in enumerate(ranked)]
    assert got == sorted(want)
