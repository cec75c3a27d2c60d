"""Operators 5 and 7 against the tokenizers' libraries and brute force."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from editpulse.llm import bpe, packing

ODD = ["", None, "don't  stop\n\n now\t x", " lead", "trail  ", "a b   c \n d", "　　x   y", "x\u0085 y\x1c z\x0b q", "I'll we've 'S",
       "中文 文字\n中", "é é  ñ12 3,4!! ...", "\x7f \x00 \r\n \r\n a", "w" * 3000, " " * 50, "\n" * 9 + "a", "🙂 🙂🙂\n🙂", "<|endoftext|> x",
       "a<|endoftext|>b <|endoftext|><|endoftext|>\n c <|endoftext", "word " * 900 + "<|endoftext|>" + " word" * 900]


def texts():
    r = random.Random(2)
    noise = ["".join(r.choice("ab é \n\t' 1, \x1c中'ts") for _ in range(r.randint(0, 80))) for _ in range(150)]
    return ODD + noise + [t for _, t in brute.corpus()]


def test_words_are_cut_at_match_boundaries():
    enc = bpe.encoder(P.path(bpe.RANKS))
    for t in texts():
        data = (t or "").encode()
        found, _ = bpe.words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        assert b"".join(found.to_pylist()) == data
        assert [i for w in found.to_pylist() for i in enc.encode_ordinary(w.decode())] == enc.encode_ordinary(t or ""), t


def test_encode_and_decode_equal_the_library(docs_of):
    enc = bpe.encoder(P.path(bpe.RANKS))
    rows = list(enumerate(texts())) + [(None, "no id"), (7, "twice"), (7, "twice")]
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids), bytes(r.decoded))
                 for r in bpe.encode_documents(docs_of(rows), chunk_bytes=2000).collect() if r.doc_id is not None)
    want = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        if i is not None:
            want.append((False, i, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha((t or "").encode()), tuple(ids), (t or "").encode()))
    assert got == sorted(want)
    assert bpe.encode_documents(docs_of([(1, "a")]).where("false")).count() == 0


def test_decode_joins_the_token_table(spark):
    enc = bpe.encoder(P.path(bpe.RANKS))
    rows = [(i, enc.encode_ordinary(t or "") if t is not None else None) for i, t in enumerate(ODD)] + [(99, [1, 10**6])]
    got = {r.k: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "k int, ids array<int>"), "k").collect()}
    assert got == {i: (None if t is None else bytearray(t.encode())) for i, t in enumerate(ODD)} | {99: None}


def ids_of(text):
    t = Tokenizer.from_file(P.path(packing.VOCABULARY))
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def test_packing_holds_every_id_once_in_gapless_sequences(docs_of):
    r = random.Random(5)
    rows = list(enumerate(texts() + ["word " * r.randint(1, 2500) for _ in range(40)]))
    pieces = packing.pack(docs_of(rows)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for i, t in rows:
        ids, at = ids_of(t), 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:at], "<u4").tobytes())
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    tokens = sum(p.length for p in pieces)
    assert sum(packing.padded(sum(k for _, k in own)) for own in by_sequence.values()) < 1.05 * tokens


def test_packing_null_ids_and_empty_table(docs_of):
    assert [(p.doc_id, p.length) for p in packing.pack(docs_of([(None, None)])).collect()] == [(None, 1)]
    assert packing.pack(docs_of([(1, "a")]).where("false")).count() == 0


@pytest.mark.parametrize("low,high,capacity", [(1, 100, 100), (34, 100, 100), (20, 51, 100), (5, 1023, 1024)])
def test_cutting_stock_is_exact_and_near_its_bound(low, high, capacity):
    r = np.random.default_rng(low)
    lengths, counts = np.unique(r.integers(low, high, 3000), return_counts=True)
    used, held = packing.solve(lengths, counts, capacity), defaultdict(int)
    for pattern, times in used:
        assert sum(n * k for n, k in pattern.items()) <= capacity
        for n, k in pattern.items():
            held[n] += k * times
    assert dict(held) == dict(zip(lengths.tolist(), counts.tolist()))
    first_fit = packing._first_fit(lengths, counts, capacity)
    cost = sum(packing.padded(sum(n * k for n, k in p.items()), capacity) * t for p, t in used)
    plain = sum(packing.padded(sum(int(lengths[i]) * k for i, k in p.items()), capacity) * t for p, t in first_fit)
    assert cost <= plain


def test_columns_are_generated_up_to_the_dual_bound(monkeypatch):
    r = np.random.default_rng(8)
    for low, high, capacity in ((34, 100, 100), (150, 600, 1024), (20, 51, 100)):
        lengths, counts = np.unique(r.integers(low, high, 4000), return_counts=True)
        pivots, pivot = [], packing._pivot
        monkeypatch.setattr(packing, "_pivot", lambda *a: pivots.append(1) or pivot(*a))
        used = packing.solve(lengths, counts, capacity)
        monkeypatch.undo()
        assert len(pivots) > len(lengths)  # more columns than the start has
        cost = sum(packing.padded(sum(n * k for n, k in p.items()), capacity) * t for p, t in used)
        assert cost >= (lengths * counts).sum() and cost <= 1.02 * packing_bound(lengths, counts, capacity) + capacity


def packing_bound(lengths, counts, capacity):
    """A bound that needs no program: tokens, and a sequence for each piece over half of one."""
    return max((lengths * counts).sum(), capacity * counts[2 * lengths > capacity].sum())


def test_pricing_equals_brute_force():
    r = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.sort(r.choice(np.arange(1, 13), 4, replace=False))
        value = r.random(4) * lengths
        cost = np.array([packing.padded(c, 12) for c in range(13)], float)
        best = max(sum(v * k for v, k in zip(value, n)) - cost[f] for n in np.ndindex(13, 13, 13, 13) if 0 < (f := int(np.dot(n, lengths))) <= 12)
        assert packing.price(value, lengths, cost)[0] == pytest.approx(best)


def test_texts_reach_the_tokenizer_a_few_mb_at_once(spark, docs_of, monkeypatch):
    """Before, a worker got up to 10000 texts as one batch while the pieces were written."""
    key, seen, staged = "spark.sql.execution.arrow.maxBytesPerBatch", [], packing.C.staged
    monkeypatch.setattr(packing.C, "staged", lambda spark, *a: (seen.append(spark.conf.get(key)), staged(spark, *a))[1])
    before = spark.conf.get(key)
    assert packing.pack(docs_of([(1, "some words"), (2, None)])).count() == 2
    assert seen == [str(4 << 20)] and spark.conf.get(key) == before
