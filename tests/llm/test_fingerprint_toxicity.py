"""Operators 9 and 10: brute force, exact properties, held-out accuracy."""

import math
import random
import zlib

import brute
import numpy as np

from editpulse.llm import common, fingerprint, toxicity

# --- 9 ----------------------------------------------------------------------


def test_entropy_scores_equal_counting():
    r = np.random.default_rng(2)
    data = np.concatenate([r.integers(97, 100, 200), np.full(150, 97), r.integers(0, 256, 300), np.tile([1, 2], 50)]).astype(np.uint8)
    got = fingerprint.entropy_scores(data)
    for i in range(0, len(data) - 63):
        c = np.bincount(data[i:i + 64])
        h = -sum(x / 64 * math.log2(x / 64) for x in c if x)
        assert abs(int(got[i]) - h / 6 * 1000) < 1.01


def brute_digest(text, rank):
    """The digest's definition, feature by feature."""
    scores = [int(s) for s in fingerprint.entropy_scores(np.frombuffer(text, np.uint8))]
    points = [0] * len(scores)
    for a in range(len(scores) - 63):
        points[min(range(a, a + 64), key=lambda i: (rank[scores[i]], i))] += 1
    chosen = [i for i, p in enumerate(points) if p >= 16]
    if scores and not chosen:
        chosen = [min(range(len(scores)), key=lambda i: (rank[scores[i]], i))]
    hashes = []
    for i in chosen:
        h = np.zeros(1, np.uint64)
        for k in range(0, 64, 8):
            h = common.mixed(h * common.BASE ^ np.frombuffer(text[i + k:i + k + 8], "<u8"))
        hashes.append(int(h[0]))
    if 0 < len(text) < 64:
        hashes = [int(common.word_hashes(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))[0])]
    out = []
    for a in range(0, len(hashes), 160):
        bits = 0
        for h in hashes[a:a + 160]:
            for k in range(5):
                bits |= 1 << (h >> (11 * k) & 2047)
        out.append(bits)
    return f"{len(out)}:", out


def test_fingerprints_edits_and_neighbours(docs_of):
    texts = [t for _, t in brute.corpus(n=30)]
    r = random.Random(8)
    texts += ["é中x " * 900, "".join(r.choice("abcdefgh ñ") for _ in range(30_000)), "x" * 63, "y" * 64]
    texts.append(texts[-3])
    r.shuffle(texts)
    rows = list(enumerate(texts))
    df = docs_of(rows)
    rank = fingerprint.rarity(df)
    got = {x.doc_id: x for x in fingerprint.fingerprint_documents(df, n_parts=7).collect()}
    assert sorted(got) == list(range(len(rows)))
    order, seen = sorted(rows, reverse=True), {}
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n, g = t or "", n or "", got[i]
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        assert (g.n_chars, g.edited, g.edited_sha256) == (len(t), edited, brute.sha(edited.encode()))
        for text, mark in ((t, g.fingerprint), (edited, g.edited_fingerprint)):
            head, filters = brute_digest(text.encode(), rank)
            assert mark.startswith(head) and [int.from_bytes(f.tobytes(), "little") for f in fingerprint.digest_of(mark)] == filters
            assert seen.setdefault(text, mark) == mark
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
        if t == n:
            assert g.near_next == 1
    big = [g for g in got.values() if g.n_chars >= 3000]
    assert big and all(g.near_edited > 0.2 for g in big)


def test_fingerprints_of_few_rows(docs_of):
    (one,) = fingerprint.fingerprint_documents(docs_of([(7, "alone " * 40)])).collect()
    assert one.near_next == 1.0 and one.n_chars == 240
    got = fingerprint.fingerprint_documents(docs_of([(1, "a b"), (1, "a b"), (None, None), (2, "")])).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "2", "None"]
    assert fingerprint.fingerprint_documents(docs_of([(1, "a")]).where("false")).count() == 0


# --- 10 ---------------------------------------------------------------------

def edits(a, b):
    """Edit distances of ``a`` to every beginning of ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def test_automaton_and_trie_equal_edit_distances():
    r = random.Random(4)
    terms = [("idiot", False), ("moron", False), ("scum", False), ("lowei", True), ("ve", True), ("abcabc", True)]
    lexicon = toxicity.Lexicon(terms)
    words = ["".join(r.choice("idotmrnlowevscuabc") for _ in range(r.randint(1, 8))) for _ in range(300)]
    for t, _ in terms:
        words += [t, t + "xyz", t[1:], t[:-1], t[:2] + "z" + t[3:], t[:2] + "z" + t[2:], t + "z", "z" + t, t[:1] + t[2:] + "qq", t[::-1]]
    for w in words:
        exact = any(w == t or (stem and w.startswith(t)) for t, stem in terms)
        near = any(len(t) >= toxicity.FUZZY_LENGTH and (min(edits(t, w)) if stem else edits(t, w)[-1]) <= 1 for t, stem in terms)
        assert lexicon.match(w) == (toxicity.DIRECT if exact else toxicity.FUZZY if near else toxicity.NONE), w


def toxic_corpus(spark, n=900):
    r = random.Random(6)
    word = lambda: "".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(r.randint(1, 3)))
    docs, labels = [], []
    for i in range(n):
        w, toxic = [word() for _ in range(r.randint(5, 120))], r.random() < 0.2
        if toxic:
            for _ in range(r.randint(1, 4)):
                w.insert(r.randrange(len(w)), r.choice(["idiot", "moron,", "Pathetic", "clown.", "loweix" + word()]))
        docs.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, int(toxic) if i % 41 else None))
    return docs, spark.createDataFrame(labels + [(10**6, 1), (None, 1)], "doc_id bigint, toxic int")


def test_held_out_accuracy_and_quotation(spark, docs_of):
    docs, labels = toxic_corpus(spark)
    extra = [(5000, None), (5001, ""), (None, "the idiot"), (5002, "you idiit and morron"), (5003, 'he said "idiot" here'), (5004, "you idiot here now"), (5004, "you idiot here now")]
    got = toxicity.score_documents(docs_of(docs + extra), labels).collect()
    by = {r.doc_id: r for r in got}
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id in by}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [i for i in truth if by[i].held_out]
    assert len(held) > 60 and sum(by[i].predicted == truth[i] for i in held) / len(held) > 0.98
    assert by[5000].predicted == by[5001].predicted == 0 and by[None].held_out and by[5004].predicted == 1
    assert by[5000].score < by[5003].score < by[5004].score and by[5002].score > by[5000].score
    assert len(got) == len(docs) + len(extra)


def test_misspelled_terms_count_beside_ordinary_neighbours(spark, docs_of):
    docs, labels = toxic_corpus(spark)
    r = random.Random(7)
    truth = {x.doc_id: x.toxic for x in labels.collect()}
    near = ["oron", "clowns", "lowei", "rloweixed", "rloweixth"]  # an edit away from moron, clown and the stem loweix
    docs = [(i, t if truth.get(i) else f"{t} {r.choice(near)} {r.choice(near)}") for i, t in docs]
    extra = {5000: "the idiit here", 5001: "on morron and pathetc", 5002: "oron the oron", 5003: "he rloweixing on clowns", 5004: "he said idiit"}
    got = {x.doc_id: x for x in toxicity.score_documents(docs_of(docs + list(extra.items())), labels).collect()}
    assert [got[i].predicted for i in sorted(extra)][:4] == [1, 1, 0, 0]
    assert got[5004].score < got[5000].score < got[5001].score
    assert all(got[i].predicted == 0 for i, t in truth.items() if t == 0 and i in got)


def test_misspelled_weight_is_never_negative():
    x = np.log1p(np.array([[2, 0, 0]] * 30 + [[0, 1, 0]] * 40 + [[0, 0, 0]] * 90, float))
    y = np.repeat([1.0, 0.0], [30, 130])
    w = toxicity.fit(x, y)
    assert w[0] > 1 and w[1] >= 0
    assert toxicity.fit(np.delete(x, np.s_[30:70], 0), np.delete(y, np.s_[30:70]))[1] > 1  # never shown: as a direct one


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark, docs_of):
    docs, labels = toxic_corpus(spark, 300)
    before = {r.doc_id: r.score for r in toxicity.score_documents(docs_of(docs), labels).collect()}
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    other = docs_of(docs).selectExpr("doc_id", "text", "'zz' lang", "'zz' source", "3 as toxic")
    assert {r.doc_id: r.score for r in toxicity.score_documents(other, flipped).collect()} == before


def test_toxicity_without_labels_or_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in toxicity.score_documents(docs_of([(1, "x")]), none).collect()] == [0.0]
    assert toxicity.score_documents(docs_of([(1, "a")]).where("false"), none).count() == 0
