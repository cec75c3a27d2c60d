"""Operator 6 against brute force."""

import contextlib
import io
import random

import brute
import numpy as np
import pytest

from editpulse.llm import components, jaccard


def shingles(text):
    w = brute.WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or "").encode())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, n=50):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdef") for _ in range(3))
    out = []
    for _ in range(5):
        base = [word() for _ in range(r.randint(6, 120))]
        for _ in range(n // 5):
            w = base[:]
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = word()
            if r.random() < 0.4:
                w += [word() for _ in range(r.randint(1, max(1, len(w) // 8)))]
            out.append(" ".join(w))
            base = w if r.random() < 0.5 else base
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(docs_of, seed):
    texts = near_copies(seed) + [t for _, t in brute.corpus(seed, n=30)] + ["A b", "a B", "a b c", "", None, "The END of it all", "the end of it all"]
    random.Random(seed).shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs_of(rows)).collect()}
    assert got == groups(rows)


@pytest.mark.parametrize("bound", [1, 7])
def test_parts_of_centres_equal_brute_force(docs_of, monkeypatch, bound):
    monkeypatch.setattr(jaccard, "PART_SETS", bound)
    monkeypatch.setattr(jaccard, "ROW_ENTRIES", 5)
    rows = list(enumerate(near_copies(5)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs_of(rows)).collect()}
    assert got == groups(rows)


def test_links_of_pairs_by_stars_and_by_derived_answers(spark, monkeypatch):
    """Centres in parts, sets that have pairs with all members of a centre."""
    r = np.random.default_rng(7)
    base = np.unique(r.integers(0, 1 << 60, 120).astype(np.uint64))
    own = {}
    for i in range(40):
        keep = base[r.random(len(base)) > 0.04 * (i % 6)]
        own[i] = np.unique(np.append(keep, r.integers(0, 1 << 60, i % 9).astype(np.uint64)))
    sets = spark.createDataFrame([(i, bytearray(a.tobytes())) for i, a in own.items()], "id bigint, own binary")
    same = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    pairs = [(c, i) for c in (0, 3) for i in range(40) if i != c]
    want = {(c, i) for c, i in pairs if same(own[c], own[i])}
    all_ = [(i, j) for i in range(40) for j in range(i)]
    linked = {(i, j) for i, j in all_ if same(own[i], own[j])}
    assert 20 < len(want) < len(pairs) and 100 < len(linked) < len(all_)
    for parts in (2000, 3):
        monkeypatch.setattr(jaccard, "PART_SETS", parts)
        links = jaccard.star_links(spark.createDataFrame(pairs, "center bigint, id bigint"), sets, 80)
        found = links.collect()
        assert {(x.u, x.v) for x in found} == want
        for x in found:
            assert set(np.frombuffer(x.lost, np.uint64)) == set(own[x.u]) - set(own[x.v]) and set(np.frombuffer(x.gained, np.uint64)) == set(own[x.v]) - set(own[x.u])
        more = jaccard.derived_links(spark.createDataFrame(all_, "x bigint, y bigint"), links, sets, 80).collect()
        of = {}
        for u, v in sorted(want):
            of.setdefault(v, u)
        got = {(x.u, x.v) for x in more}
        # a link for each set and centre that has one
        assert got <= linked and len(got) == len(more)
        assert {(of.get(u, u), v) for u, v in got} == {(of.get(u, u), v) for u, v in linked}


def test_sketches_drop_no_pair_that_links(spark):
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 400).astype(np.uint64) * np.uint64(2)
    own = [np.unique(np.append(base[:r.integers(200, 400)], r.integers(0, 1 << 60, r.integers(0, 60)).astype(np.uint64))) for _ in range(30)]
    own += [np.arange(300, dtype=np.uint64), np.arange(290, dtype=np.uint64)]  # one counter, too small
    sketch = lambda a: np.bincount((a >> np.uint64(56)).astype(int), minlength=256)
    sets = spark.createDataFrame([(i, len(a), bytearray(sketch(a).astype(np.uint8).tobytes() if sketch(a).max() < 256 else b""), bytearray(a.tobytes())) for i, a in enumerate(own)],
                                 "id bigint, n bigint, sketch binary, own binary")
    all_ = [(i, j) for i in range(32) for j in range(i)]
    left = {(x.u, x.v) for x in jaccard.plausible(spark.createDataFrame(all_, "u bigint, v bigint"), sets, 80).collect()}
    linked = {(i, j) for i, j in all_ if 100 * len(np.intersect1d(own[i], own[j])) >= 80 * len(np.union1d(own[i], own[j]))}
    assert linked <= left and (31, 30) in left and len(left) < len(all_) / 2


def test_several_texts_under_one_id(docs_of):
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(5, one), (5, two), (7, two + " x"), (3, three), (3, one + " y"), (9, "word"), (9, ""), (9, None), (7, two + " x")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs_of(rows)).collect())
    assert got == sorted([(5, 36, 3), (5, 36, 5), (7, 37, 5), (7, 37, 5), (3, 36, 3), (3, 37, 3), (9, 1, 9), (9, 0, 9), (9, 0, 9)])
    kept = sorted((r.doc_id, r.text, r.key) for r in jaccard.one_of_each_group(docs_of(rows)).collect())
    assert kept == sorted([(3, one + " y", "x"), (5, two, "x"), (3, three, "x"), (9, "word", "x"), (9, "", "x")])


def test_comparisons_are_as_many_as_sets(spark, docs_of, monkeypatch):
    """A large group of near copies: each set is compared with a few centres, and
    pairs in the group are not."""
    r = random.Random(1)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(300):
        w = base[:]
        w[r.randrange(100)] = f"e{i}"
        rows.append((i, " ".join(w)))
    asked, stars = [], jaccard.star_links
    monkeypatch.setattr(jaccard, "star_links", lambda pairs, sets, percent: asked.append(pairs.count()) or stars(pairs, sets, percent))
    derived = jaccard.derived_links
    monkeypatch.setattr(jaccard, "derived_links", lambda pairs, links, sets, percent: asked.append(pairs.count()) or derived(pairs, links, sets, percent))
    assert {x.component_id for x in jaccard.similar_groups(docs_of(rows)).collect()} == {0}
    assert len(asked) == len(jaccard.WIDTHS) + 1 and max(asked) <= 300 and sum(asked[1:]) < 100


def test_sets_beside_a_large_group_leave_their_lists_only_if_they_may_link(spark, docs_of, monkeypatch):
    """Sets that share rare words with all of a large group and link to none of it: the
    passage that each has of its own is a common one."""
    slot = lambda kind, s: [f"{kind}{s}_{j}" for j in range(25)]
    rows = [(1000 + i, " ".join(w for s in range(8) for w in slot("v", s))) for i in range(150)]
    for i in range(132):
        w = [slot("v" if i >= 100 and i % 8 == s else "w", s) for s in range(8)]
        w[(i + 3) % 8][i % 25] = f"e{i}"
        rows.append((i, " ".join(x for part in w for x in part)))
    made, across = spark.sparkContext.accumulator(0), jaccard._across

    def counted(*args):
        def run(batches):
            for batch in across(*args)(batches):
                made.add(batch.num_rows)
                yield batch
        return run

    monkeypatch.setattr(jaccard, "_across", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs_of(rows)).collect()}
    assert got == groups(rows) and sum(c == 0 for _, c in got.values()) == 100
    assert made.value < len(rows)


def test_pairs_of_lists_are_those_that_sketches_leave():
    """Also sets whose sketch is empty, and parts of a probe's partners."""
    r = np.random.default_rng(8)
    base = r.integers(0, 1 << 63, 120).astype(np.uint64) * np.uint64(2)
    own = [np.unique(np.append(base[r.random(120) > 0.05 * (i % 5)], r.integers(0, 1 << 60, i % 7).astype(np.uint64))) for i in range(40)]
    cells = np.stack([np.bincount((a >> np.uint64(56)).astype(int), minlength=256).astype(np.uint8) for a in own])
    cells[7] = cells[9] = 255
    ids, n, group = np.arange(40) * 3 + 1, np.array([len(a) for a in own]), np.arange(40) % 9
    pack = jaccard.C.pack
    lists = pack(np.array([40]), ids, n, np.zeros(40, np.int64), group)
    schema = jaccard.pa.schema([("bucket", jaccard.pa.int32()), ("kind", jaccard.pa.int32()), ("blob", jaccard.pa.binary())])
    rows = jaccard.C.table(schema, [5, 5, 5], [0, 0, 1], [pack(ids[20:], cells[20:].ravel()), pack(ids[:20], cells[:20].ravel()), lists])
    got = {(x, y) for b in jaccard._across(80)(iter([rows])) for x, y in zip(*b.to_pydict().values())}
    met = {(min(i, j), max(i, j)) for i, j in jaccard.probes(n, np.zeros(40, int), group, 80)}
    want = {(ids[i], ids[j]) for i, j in met if jaccard.may_link(cells[[i]], cells[[j]], n[i] + n[j], 80)[0]}
    linked = {(ids[i], ids[j]) for i, j in met if 100 * len(np.intersect1d(own[i], own[j])) >= 80 * len(np.union1d(own[i], own[j]))}
    assert got == want and linked <= got and len(linked) < len(got) < len(met)


def test_no_stored_step_has_a_large_plan(docs_of, monkeypatch):
    """The driver holds a step's plan anew whenever a part of it has run."""
    sizes, staged = [], jaccard.C.staged

    def counted(spark, df, purpose):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain()
        sizes.append((plan.getvalue().count("\n"), purpose))
        return staged(spark, df, purpose)

    monkeypatch.setattr(jaccard.C, "staged", counted)
    rows = list(enumerate(near_copies(2)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs_of(rows)).collect()}
    assert got == groups(rows)
    assert max(sizes)[0] < 80, sorted(sizes)[-5:]


def test_null_ids_repeated_rows_and_empty_table(docs_of):
    t = "one two three four five six seven"
    got = jaccard.similar_groups(docs_of([(4, t), (4, t), (9, t), (None, t), (None, None), (1, "")])).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id if r.n_shingles else 0) for r in got) == [
        ("1", 0, 0), ("4", 3, 4), ("4", 3, 4), ("9", 3, 4), ("None", 0, 0), ("None", 3, 4)]
    assert jaccard.similar_groups(docs_of([(1, "a")]).where("false")).count() == 0


def test_probes_lose_no_pair_that_can_link():
    r = np.random.default_rng(4)
    n = r.integers(5, 60, 80)
    pos = (r.random(80) * (n // 5 + 1)).astype(int)
    group = r.integers(0, 6, 80)
    got = {(min(i, j), max(i, j)) for i, j in jaccard.probes(n, pos, group, 80)}
    for i in range(80):
        for j in range(i):
            need = -(-80 * (n[i] + n[j]) // 180)
            if group[i] != group[j] and min(n[i], n[j]) * 100 >= 80 * max(n[i], n[j]) and min(n[i] - pos[i], n[j] - pos[j]) >= need:
                assert (j, i) in got


def test_components_of_chains_stars_and_pairs(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.v: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(1, 21)} | {i: 100 for i in range(101, 140)} | {201: 200}
