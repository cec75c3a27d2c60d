import json


from collected import rows
from editpulse.functions.parse import (
    namespace_filter,
    parse_edits,
    rejected_edits,
    sse_frames,
    to_wire_json,
    valid_edits,
    wiki_filter,
)
from editpulse.operators.counters import ingest_counters
from editpulse.schema import CORRUPT_COL


def msg(**kw):
    base = {"id": "1", "title": "A", "user": "u", "type": "edit", "namespace": 0,
            "timestamp": 1700000000}
    base.update(kw)
    return json.dumps(base)


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_sse_frames_keep_only_data_lines(spark):
    df = lines(spark, [":ok", "event: message", "id: [1]", "", "data: {\"a\":1}",
                       "data:{\"no_space\":1}", "data: ", None])
    assert rows(sse_frames(df)) == [("",), ('{"a":1}',)]


def test_parse_clean_message(spark):
    out = parse_edits(lines(spark, [msg()])).collect()[0]
    assert (out.id, out.title, out.user, out.type, out.namespace, out.timestamp) == (
        "1", "A", "u", "edit", 0, 1700000000)
    assert out[CORRUPT_COL] is None
    assert out.event_time.isoformat().startswith("2023-11-14T22:13:20")


def test_parse_garbage_and_null(spark):
    out = parse_edits(lines(spark, ["garbage", None])).collect()
    for r in out:
        assert all(r[c] is None for c in ("id", "title", "user", "type", "namespace", "timestamp"))
    assert sorted(str(r[CORRUPT_COL]) for r in out) == ["None", "garbage"]


def test_parse_wrong_types_null_only_that_field(spark):
    vals = [msg(namespace="0"), msg(timestamp="notnum"), msg(timestamp=1700000002.7)]
    out = parse_edits(lines(spark, vals)).collect()
    by_ns = [r for r in out if r.namespace is None]
    assert len(by_ns) == 1 and by_ns[0].timestamp == 1700000000 and by_ns[0].user == "u"
    assert sum(1 for r in out if r.timestamp is None) == 2
    assert all(r[CORRUPT_COL] is not None for r in out)


def test_parse_extra_nested_ignored_and_object_in_string_kept(spark):
    vals = [msg(meta={"x": 1}), msg(title={"a": 1})]
    out = parse_edits(lines(spark, vals)).collect()
    titles = sorted(r.title for r in out)
    assert titles == ["A", '{"a":1}']


def test_rejections(spark):
    vals = [msg(user=None), msg(user="x" * 256), msg(user="x" * 255), msg(timestamp=None),
            "garbage", msg(title="t" * 501)]
    parsed = parse_edits(lines(spark, vals))
    reasons = sorted(r.reject_reason for r in rejected_edits(parsed).collect())
    assert reasons == ["not_json", "null_timestamp", "null_user", "user_too_long"]
    assert valid_edits(parsed).count() == 2  # 255-char user, 501-char title
    page_reasons = sorted(r.reject_reason for r in rejected_edits(parsed, "top_pages").collect())
    assert page_reasons == ["not_json", "null_timestamp", "title_too_long"]


def test_namespace_filter_missing_is_dropped(spark):
    vals = [msg(namespace=0), msg(namespace=1), json.dumps({"id": "x", "user": "u", "timestamp": 1})]
    parsed = parse_edits(lines(spark, vals))
    assert [r.namespace for r in namespace_filter(parsed, [0]).collect()] == [0]
    assert namespace_filter(parsed, None).count() == 3
    assert sorted(r.namespace for r in namespace_filter(parsed, [0, 1]).collect()) == [0, 1]


def test_wiki_filter(spark):
    vals = [msg(wiki="enwiki"), msg(wiki="dewiki"), msg()]
    parsed = parse_edits(lines(spark, vals))
    assert wiki_filter(parsed, []).count() == 3
    assert [r.wiki for r in wiki_filter(parsed, ["enwiki"]).collect()] == ["enwiki"]


def test_wire_round_trip(spark):
    vals = [msg(), msg(id="2", title='quote " and, comma', namespace=4)]
    parsed = parse_edits(lines(spark, vals))
    again = parse_edits(to_wire_json(parsed))
    cols = ("id", "title", "user", "type", "namespace", "timestamp")
    assert rows(again, *cols) == rows(parsed, *cols)


def test_ingest_counters(spark):
    vals = [msg(namespace=0), msg(namespace=1), msg(namespace="0"), "garbage", None,
            json.dumps({"id": "x"})]
    parsed = parse_edits(lines(spark, vals), keep_raw=True)
    r = ingest_counters(parsed, [0]).collect()[0]
    assert (r.events_seen, r.events_sent) == (4, 1)
    r = ingest_counters(parsed, None).collect()[0]
    assert (r.events_seen, r.events_sent) == (4, 4)
