"""Operators 1, 3 and 4 against brute force."""

import glob
import gzip
import hashlib
import random
import re
import time

import numpy as np
import pytest
import xxhash

from editpulse.llm import bitslice, urlfilter, warc
from editpulse.session import scratch_dir


# --- 3 ----------------------------------------------------------------------

def brute_top(rows, k=5):
    ints = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows}
    out = []
    for q in sorted(i for i in ints if i % 50 == 0):
        dot = lambda a, b: int(np.dot(a[:min(len(a), len(b))], b[:min(len(a), len(b))]))
        best = sorted(((-dot(ints[q], v), i) for i, v in ints.items() if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def search(spark, rows, **options):
    df = bitslice.usable(spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id bigint, embedding array<float>, block string, score double"))
    return sorted(tuple(r) for r in bitslice.top_k(df, df.where("vec_id % 50 = 0"), **options).collect())


@pytest.mark.parametrize("dropped", [0, 2, 4])
def test_top_k_equals_brute_force(spark, dropped):
    r = np.random.default_rng(dropped)
    rows = [(int(i), np.float32(r.normal(size=16) / 4).tolist()) for i in r.permutation(400)]
    rows += [(400 + i, rows[i % 3][1]) for i in range(60)] + [(500, [0.0] * 16), (550, [-3.0] * 16), (601, [1.0, 2.0]), (650, [])]
    assert search(spark, rows, dropped=dropped, block_rows=130, query_rows=4) == brute_top(rows)


def test_top_k_sends_nothing_through_the_driver(spark):
    r = np.random.default_rng(5)
    rows = [(int(i), np.float32(r.normal(size=8) * 10.0 ** (i % 6)).tolist()) for i in r.permutation(600)] + [(600 + i, [0.0] * 8) for i in range(20)]
    df = bitslice.usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    for options in ({"block_rows": 100, "query_rows": 3}, {"block_rows": 4, "query_rows": 2}):  # fewer blocks than tasks; more than the tasks hold at once
        found = bitslice.top_k(df, df.where("vec_id % 50 = 0"), **options)
        assert sorted(tuple(x) for x in found.collect()) == brute_top(rows)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "Join" not in plan and "BroadcastExchange" not in plan


def test_parts_are_as_many_as_tasks_and_held_in_memory():
    for n, n_blocks, n_queries in ((8, 1, 1), (12, 7, 5), (24, 76, 49), (200, 7, 5), (12, 500, 300)):
        parts, shares = bitslice._grid(n, n_blocks, n_queries)
        assert -(-n_blocks // parts) <= bitslice.HELD_BLOCKS and parts <= n_blocks and 1 <= shares <= n_queries
        assert parts * (shares - 1) < n  # copies of the index
    assert bitslice._grid(24, 76, 49) == (24, 1)


def test_top_k_leaves_out_unusable_vectors(spark):
    good = [(0, [1.0, 0.5]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    bad = [(50, None), (3, [1.0, None]), (100, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    assert search(spark, good + good + bad) == brute_top(good)
    assert search(spark, [(0, [1.0])]) == [] and search(spark, [(1, None)]) == []


def test_slices_add_up_and_are_walked_downward():
    r = np.random.default_rng(9)
    vectors, weights = r.integers(-100, 100, (150, 7)), r.integers(-60, 60, 7)
    slices = bitslice.build(vectors, 0)
    valid = np.packbits(np.arange(slices.shape[2] * 64) < 150, bitorder="little").view(np.uint64)
    score = bitslice.add_slices(slices, weights, valid)
    got = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:150].astype(int) << b for b, s in enumerate(score))
    want = vectors @ weights
    assert len(set((got - want).tolist())) == 1
    for k in (1, 7, 150):
        value = bitslice.kth_best(score, valid, k)
        assert value == np.sort(got)[-k]
        assert bitslice.numbers(bitslice.at_least(score, valid, value), 150).tolist() == np.flatnonzero(got >= value).tolist()


# --- 4 ----------------------------------------------------------------------

URLS = ["http://a.Example.NET/en/x?y", "http://example.net/en", "http://example.net/en/", "https://net/", "https://net", "http://x.y.net?q=/en/", "http://b.example.com/de/1#t",
        "http://example.com.org/fr/", "http://ORG/fr/a", "http://notexample.com/de/", "http://.net/", "ftp://example.net", "no scheme", "", None, "http://", "://net/x", "http://a.net//://b.org/fr/",
        "http://u@example.com:80/de/", "http://ÄA.net/é", "http://" + "a." * 300 + "net/" + "p" * 5000]


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, "allow"), key=lambda f: f[0])
    return host, path, best[1], best[2]


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_urls_equal_brute_force(spark, max_bytes):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(3, URLS[3], None), (None, URLS[0], None)]
    got = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, host string"), max_bytes=max_bytes).collect()
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got))) == sorted(str((i, *brute_url(u, urlfilter.RULES))) for i, u, _ in rows)
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_equal_digests_are_told_apart_by_the_stored_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(urlfilter.xxhash, "xxh64_intdigest", lambda s: xxhash.xxh32_intdigest(s) % 3)
    r = random.Random(1)
    rules = [("".join(r.choice("abc") for _ in range(r.randint(1, 4))), "/", "block") for _ in range(40)]
    (tmp_path / "rules").write_bytes(urlfilter.digest_array(rules))
    array = urlfilter.DigestArray(str(tmp_path / "rules"))
    known = {h.encode() + b"/" for h, *_ in rules}
    asked = sorted(known) + [b"zz/", b"", b"a"]
    got = array.probe(asked)
    for c, k in zip(asked, got):
        assert (k >= 0) == (c in known)
        if k >= 0:
            assert array.strings[array.offsets[k]:array.offsets[k + 1]].tobytes() == c


# --- 1 ----------------------------------------------------------------------

PAGE = "<html><title>A &amp; B\n</title><script>var x='<p>no</p>'</script><p>One<br>two <b>b</b>old&nbsp;x</p><!-- <p>gone --><a href='/x'>link</a><style>p{}</style><div>&#233;&lt;t&gt;"


def test_derived_records_refer_to_their_response_and_round_trip_as_files(spark):
    rows = [(1, "http://a.net/", PAGE, 5), (1, "http://a.net/", PAGE, 5), (2, None, None, None), (None, "http://b.net/", "plain\r\n\r\ntext", 1), (4, "u", "<p" * 3000, 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, block int")
    responses = warc.responses_of(pages)
    sources = {r.record_id: r for r in responses.collect()}
    records = warc.derivatives(responses)
    got = records.collect()
    assert len(got) == 2 * len(rows) and {r.refers_to for r in got} == set(sources) and all(r.digest_ok for r in got)
    one = {r.warc_type: r for r in got if r.page_id == 1}
    assert one["conversion"].block == "A & B\nOne\ntwo bold x\nlink\né<t>"
    fields = dict(line.split(": ", 1) for line in one["metadata"].block.splitlines())
    assert fields["title"] == "A & B" and fields["links"] == "1" and fields["http-status"] == "HTTP/1.1 200 OK" and fields["conversion"] == one["conversion"].record_id
    assert fields["source-payload-digest"] == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest() == one["conversion"].source_payload_digest
    assert "http-header: Content-Type: text/html; charset=utf-8" in one["metadata"].block
    path = scratch_dir(spark, "warc")
    warc.write_warc(records, path)
    read = []
    for name in glob.glob(f"{path}/*.gz"):
        data = gzip.open(name).read()
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines)
            n = int(fields["Content-Length"])
            assert version == "WARC/1.1" and data[n:n + 4] == b"\r\n\r\n" and fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(data[:n]).hexdigest()
            read.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], data[:n].decode()))
            data = data[n + 4:]
    assert sorted(read) == sorted((r.record_id, r.refers_to, r.block) for r in got)


def test_derivatives_of_odd_responses(spark):
    assert warc.derivatives(warc.responses_of(spark.createDataFrame([], "page_id bigint, url string, html string"))).count() == 0
    odd = spark.createDataFrame([(1, "<urn:1>", "u", None, bytearray(b"no headers"), None, None), (2, None, None, None, None, "sha256:0", None)],
                                "page_id bigint, record_id string, target_uri string, date string, block binary, block_digest string, payload_digest string")
    got = {(r.page_id, r.warc_type): r for r in warc.derivatives(odd).collect()}
    assert got[1, "conversion"].block == "no headers" and got[1, "conversion"].digest_ok is None and got[2, "metadata"].digest_ok is False


# --- long input ---------------------------------------------------------------

def test_pages_of_unclosed_tags_take_time_in_proportion():
    begin = time.time()
    for page in ("<a " * 350_000, "<title>" * 150_000, "<title " * 150_000, "<a href" * 150_000, "</title " * 130_000, "<!--" * 260_000, "<script>" * 130_000):
        assert warc.title_of(page) == "" and warc.links_of(page) == 0 and warc.plain_text(page) is not None
    assert time.time() - begin < 30


def test_titles_and_links_equal_the_plain_patterns():
    title, link = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.I | re.S), re.compile(r"<a\b[^>]*\bhref\s*=", re.I)
    r = random.Random(4)
    for _ in range(3000):
        page = "".join(r.choice(["<a", " ", ">", "href", "=", "<", "a", "<title", "</title", "x", "\n", "-href =", "<A HREF="]) for _ in range(r.randint(0, 14)))
        found = title.search(page)
        assert warc.links_of(page) == len(link.findall(page)), page
        assert warc.title_of(page) == (warc._tidy(warc._TAG.sub("", found[1])).replace("\n", " ") if found else ""), page


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_hosts_of_any_length_and_rules_of_other_letters(spark, max_bytes):
    rules = (*urlfilter.RULES, ("é.net", "/", "allow"), ("net", "/中", "block"), ("é.net", "/中", "allow"), ("net", "/abc", "allow"))
    urls = ["http://" + "." * 1_000_000 + "net/", "http://" + "a." * 300_000 + "é.net/中", "http://" + "x" * 500_000 + "/de/", "http://é.net/中", "http://net/中", "http://net/abc"]
    begin = time.time()
    got = urlfilter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), rules, max_bytes).collect()
    assert time.time() - begin < 60
    best = lambda host, path: max(((len((h + p).encode()), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, "allow"))
    for r in got:
        assert (r.rule, r.verdict) == best(r.host, r.path)[1:], r.page_id
