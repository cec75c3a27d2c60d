"""Operators 2 and 8 against brute force."""

import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest

from editpulse.llm import common, suffixindex, superkmer, windows
from editpulse.llm.suffixindex import SuffixArrayFamily, dedup_substrings
from editpulse.llm.superkmer import dedup_windows


def test_sliding_min():
    r = np.random.default_rng(1)
    a = r.integers(0, 50, 333).astype(np.uint64)
    for w in (1, 2, 7, 85, 333, 400):
        want = [a[i:i + w].min() for i in range(len(a) - w + 1)]
        assert common.sliding_min(a, w).tolist() == want


def test_words_of_matches_the_pattern():
    for _, t in brute.corpus():
        b = (t or "").encode()
        data = np.frombuffer(b"pre " + b + b"next", np.uint8)
        start, end, first = common.words_of(data, np.array([0, 4, 4 + len(b), 8 + len(b)]))
        own = [data[s:e].tobytes() for s, e in zip(start[first[1]:first[2]], end[first[1]:first[2]])]
        assert own == brute.WORDS.findall(b)


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("hot", [20_000, 3])
def test_superkmer_equals_brute_force(docs_of, seed, hot):
    rows = brute.corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in dedup_windows(docs_of(rows), hot_runs=hot).collect()}
    want = brute.words_removed(rows)
    assert got == want and sum(w[1] for w in want.values()) > 500


@pytest.mark.parametrize("of_words", [False, True])
def test_windows_of_a_hot_key_are_never_gathered(docs_of, monkeypatch, of_words):
    """One passage in many documents: no task matches the strings of all of them."""
    passage = " ".join(f"p{j * j}" for j in range(60))
    rows = [(i, f"{'é' * (i % 7)} head{i} {passage} tail{i * i}") for i in range(60)]

    def refuse(window, of_words):
        def match(batches):
            for batch in batches:
                if len(batch):
                    raise ValueError("gathered")
            yield from ()
        return match

    monkeypatch.setattr(windows, "_matcher", refuse)
    if of_words:
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in dedup_windows(docs_of(rows), hot_runs=2).collect()}
        assert got == brute.words_removed(rows)
    else:
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_substrings(docs_of(rows), n_batches=1, hot_runs=1).collect()}
        assert got == brute.bytes_removed(rows)


def test_superkmer_null_ids_repeated_rows_and_empty_table(docs_of):
    t = " ".join(f"w{i}" for i in range(80))
    got = sorted(((r.doc_id, r.n_removed) for r in dedup_windows(docs_of([(None, t), (5, t), (5, t), (1, "x"), (None, None)])).collect()), key=str)
    assert got == [(1, 0), (5, 0), (5, 0), (None, 0), (None, 80)]
    assert dedup_windows(docs_of([(1, "a")]).where("false")).count() == 0


@pytest.mark.parametrize("batches", [1, 3, 4])
@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffix_arrays_equal_brute_force(docs_of, batches, hot):
    rows = brute.corpus(5 + batches)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in dedup_substrings(docs_of(rows), n_batches=batches, hot_runs=hot).collect()}
    want = brute.bytes_removed(rows)
    assert got == want and sum(w[1] for w in want.values()) > 5000


def test_strings_of_just_the_window_between_other_text(docs_of):
    """Passages of 99, 100 and 101 bytes at every distance from the texts' edges, and periodic ones."""
    r = np.random.default_rng(8)

    def noise(n):
        return "".join(chr(x) for x in r.integers(97, 123, n))

    rows = []
    for i in range(60):
        shared = noise((99, 100, 101)[i % 3]) if i % 4 else ("ab" * 80)[:100 + i % 7]
        rows += [(2 * i, noise(i) + shared + noise(60 - i)), (2 * i + 1, noise(60 - i) + shared + noise(i % 5))]
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in dedup_substrings(docs_of(rows)).collect()}
    want = brute.bytes_removed(rows)
    assert got == want and sum(w[1] > 0 for w in want.values()) > 40


def test_anchors_that_agree_in_24_bytes_only_are_no_seeds(spark, docs_of):
    """One common 30-byte string between different texts; and the levels are in true order."""
    r = np.random.default_rng(9)
    common_part = "0123456789abcdefghij0123456789"
    rows = [(i, "".join(chr(x) for x in r.integers(97, 123, 150)) + common_part + "".join(chr(x) for x in r.integers(97, 123, 150))) for i in range(300)]
    index = SuffixArrayFamily(spark, n_buckets=2)
    found = [index.add(common.keyed(docs_of(part))).count() for part in (rows[:150], rows[150:])]
    assert found == [0, 0]
    for row in index._level(index.levels[1]).collect():
        high, mid, low = common.unpack(bytes(row.blob))[:3]
        begin = list(zip(high.tolist(), mid.tolist(), low.tolist()))
        assert begin == sorted(begin) and len(begin) > 300
    index.drop()


def test_levels_merge_geometrically(spark, docs_of):
    index, sizes = SuffixArrayFamily(spark, n_buckets=2), []
    for i in range(7):
        index.add(common.keyed(docs_of([(i, "".join(chr(97 + (i * j * j + j) % 23) for j in range(300)))])))
        sizes.append(sorted(index.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2], [1, 2], [0, 1, 2]]


def test_index_functions_get_a_few_mb_at_once(spark):
    """Rows of 1 MB: before, all of a partition came as one batch (and to_pylist copied it)."""
    rows = spark.range(0, 24, 1, 1).selectExpr("id", "repeat('x', 1048576) AS blob")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    def most():
        return max(r.n for r in rows.mapInArrow(sizes, "n bigint").collect())

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    outside, before = most(), spark.conf.get(key)
    with common.small_batches(spark):
        assert most() <= 6 << 20 < outside
    assert spark.conf.get(key) == before


def test_a_bucket_is_a_part_of_a_partition(spark, docs_of):
    """Before, one array held all suffixes of a shuffle partition."""
    r = np.random.default_rng(10)
    index = SuffixArrayFamily(spark)
    index.add(common.keyed(docs_of([(i, "".join(map(chr, r.integers(97, 123, 3000)))) for i in range(60)])))
    buckets = sorted(r.bucket for r in index._level(index.levels[0]).select("bucket").collect())
    assert len(buckets) == len(set(buckets)) > 2 * common.partitions(spark)
    index.drop()


@pytest.mark.parametrize("of_words", [False, True])
def test_strings_are_matched_a_few_mb_at_a_time(monkeypatch, of_words):
    """Before, 8 MB at once, for which a worker took half a GB."""
    seen, whole = [], windows.covered
    monkeypatch.setattr(windows, "covered", lambda strings, *a: (seen.append(strings.nbytes), whole(strings, *a))[1])
    r = np.random.default_rng(11)

    def batches():
        for i in range(60):
            s = [bytes(r.integers(97, 123, 600, dtype=np.uint8)) for _ in range(100)] * 2  # each string twice
            key, at = np.repeat(np.arange(100) + 100 * i, 2), np.arange(200) + 200 * i
            order = np.argsort(np.tile(np.arange(100), 2), kind="stable")
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(at), pa.array(at), pa.array(np.zeros(200, np.int32)),
                                              pa.array([s[k] for k in order], pa.binary())], names=["key", "id", "h", "start", "s"])

    found = pa.Table.from_batches(windows._matcher(1 if of_words else 100, of_words)(batches()))
    assert sorted(found["id"].to_pylist()) == list(range(1, 12_000, 2))  # the second of each two
    assert len(seen) >= 3 and max(seen) <= 3 << 20


def test_one_large_batch_of_strings_is_matched_in_parts(monkeypatch):
    """Before, a batch was matched whole, whatever its size."""
    seen, whole = [], windows.covered
    monkeypatch.setattr(windows, "covered", lambda strings, *a: (seen.append(strings.nbytes), whole(strings, *a))[1])
    r = np.random.default_rng(12)
    s = [bytes(r.integers(97, 123, 600, dtype=np.uint8)) for _ in range(5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(5000), 2)), pa.array(np.arange(10_000)), pa.array(np.arange(10_000)), pa.array(np.zeros(10_000, np.int32)),
                                        pa.array([s[k // 2] for k in range(10_000)], pa.binary())], names=["key", "id", "h", "start", "s"])
    found = pa.Table.from_batches(windows._matcher(100, False)(iter([batch])))
    assert sorted(found["id"].to_pylist()) == list(range(1, 10_000, 2))
    assert len(seen) >= 4 and max(seen) <= 2 << 20


@pytest.mark.parametrize("module, dedup, name", [(suffixindex, dedup_substrings, "n_bytes"), (superkmer, dedup_windows, "n_words")])
def test_results_are_made_from_a_few_mb_at_once(spark, monkeypatch, module, dedup, name):
    """Before, the caller's write handed the last functions whole partitions."""
    schema = pa.schema([("doc_id", pa.int64()), (name, pa.int64()), ("n_removed", pa.int64())] + [("n_spans", pa.int64())] * (name == "n_bytes") + [("kept_sha256", pa.string())])

    def sizes(batches):
        for batch in batches:
            yield common.table(schema, batch["doc_id"], *[[batch.nbytes] * len(batch)] * (len(schema) - 2), [""] * len(batch))

    monkeypatch.setattr(module, "_kept", lambda with_text: sizes)
    r = np.random.default_rng(14)
    docs = spark.createDataFrame([(i, "".join(map(chr, r.integers(97, 123, 1 << 20)))) for i in range(16)], "doc_id bigint, text string")
    with common._held(spark, "spark.sql.shuffle.partitions", "1"):
        got = [x[name] for x in dedup(docs, with_text=False).collect()]
    assert len(got) == 16 and max(got) <= 6 << 20


def test_scan_holds_a_few_times_its_suffixes():
    """Before: 1 MB of text scanned at once, and five copies of what is dealt out."""
    r = np.random.default_rng(13)
    text = pa.array(["".join(map(chr, x)) for x in r.integers(97, 123, (1000, 4000))])
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(1000)), text], names=["id", "text"])
    tracemalloc.start()
    rows = sum(len(b) for b in suffixindex._scan(100, 200)(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 200 and most < 50 << 20


def test_suffix_arrays_null_ids_repeated_rows_and_empty_table(docs_of):
    t = "".join(chr(97 + (j * j + j // 7) % 26) for j in range(150))
    got = sorted(((r.doc_id, r.n_removed) for r in dedup_substrings(docs_of([(None, t), (5, t), (5, t), (1, "x"), (None, None)])).collect()), key=str)
    assert got == [(1, 0), (5, 0), (5, 0), (None, 0), (None, 150)]
    assert dedup_substrings(docs_of([(1, "a")]).where("false")).count() == 0
