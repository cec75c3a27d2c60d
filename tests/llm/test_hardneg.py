"""Operator 12 against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from editpulse.llm import common, hardneg


def mined(rows, anchor, k=5, low=80, high=100):
    """All results, as sorted tuples, of ``(vec_id, label, vector)`` rows."""
    ok = [(i, g, v) for i, g, v in rows if None not in (i, g, v) and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for *_, v in ok), default=0)
    x = [[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (d - len(v)) for *_, v in ok]
    out = []
    for a, (i, g, _) in enumerate(ok):
        if anchor(i):
            score = [sum(p * q for p, q in zip(x[a], y)) for y in x]
            same = sorted((-score[b], ok[b][0], b) for b in range(len(ok)) if b != a and ok[b][1] == g)[:k]
            for s, pos, _ in same:
                fit = sorted((-score[b], ok[b][0]) for b in range(len(ok)) if ok[b][1] != g and low * -s <= 100 * score[b] <= high * -s)[:k]
                out += [(i, pos, r + 1, j, -s, -t) for r, (t, j) in enumerate(fit)]
    return sorted(out)


def table(spark, rows):
    rows = [(i, g, v, 1.5, "x") for i, g, v in rows]
    return spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>, score double, block string")


def run(spark, rows, anchors="vec_id % 9 = 0", **options):
    got = hardneg.hard_negatives(hardneg.usable(table(spark, rows)), F.expr(anchors), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(seed=1, n=240, d=6, labels=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(labels, d))
    rows = [(int(i), int(g), [float(c) for c in centres[(g + (i % 3 == 0)) % labels] + 0.4 * r.normal(size=d)]) for i, g in enumerate(r.integers(0, labels, n))]
    rows += [(n + i, rows[5][1] if i % 4 else 3, rows[5][2]) for i in range(60)]  # copies, ties
    rows += [(400, None, [1.0] * d), (401, 1, None), (None, 1, [1.0] * d), (402, 1, [1.0, None]), (403, 1, [float("nan")]), (404, 1, [float("inf")])]
    return rows + [(405, 1, []), (414, 2, [0.0] * d), (406, 2, [0.5]), (423, 99, [1.0] * d)]


@pytest.mark.parametrize("options", [{}, {"block_rows": 16, "leaf_rows": 4, "growth": 2, "query_rows": 3}, {"block_rows": 40, "leaf_rows": 1, "growth": 3}])
def test_hard_negatives_equal_brute_force(spark, options):
    rows = vectors()
    want = mined(rows, lambda i: i % 9 == 0)
    assert run(spark, rows, **options) == want and len(want) > 200


def test_repeated_ids_and_rows(spark):
    rows = vectors(3, 60) + [(9, 1, [1.0, 0.5]), (9, 1, [1.0, 0.5]), (9, 2, [1.0, 0.4]), (12, 2, [1.0, 0.5]), (12, 2, [1.0, 0.5])]
    assert run(spark, rows, block_rows=8, growth=2) == mined(rows, lambda i: i % 9 == 0)


def test_windows_of_other_bounds_and_negative_scores(spark):
    rows = vectors(4, 90, labels=2)
    for low, high in ((90, 95), (50, 130), (33, 77)):
        assert run(spark, rows, low=low, high=high, positives=3, negatives=3) == mined(rows, lambda i: i % 9 == 0, 3, low, high)
    far = [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.9]), (3, 2, [-1.0])]
    assert run(spark, far) == mined(far, lambda i: i % 9 == 0) == []


def test_empty_and_unusable_tables(spark):
    assert run(spark, [(1, None, [1.0])]) == [] and run(spark, [(0, 1, [1.0])]) == [] and run(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert hardneg.hard_negatives(hardneg.usable(table(spark, [(1, 1, [1.0])])).where("false"), F.lit(True)).count() == 0


def test_trees_hold_every_row_in_its_boxes():
    r = np.random.default_rng(2)
    for n, d, leaf in ((1, 3, 4), (5, 1, 4), (1000, 3, 7), (777, 8, 64), (300, 2, 1)):
        x = r.integers(-9, 9, (n, d))
        order, low, high, first, last, leaves = hardneg.pack_tree(x, leaf, 4)
        assert sorted(order) == list(range(n)) and last[leaves - 1] == n and len(low) == len(first)

        def rows_of(node):
            if node < leaves:
                assert 0 < last[node] - first[node] <= leaf
                return list(order[first[node]:last[node]])
            return [i for c in range(first[node], last[node]) for i in rows_of(c)]

        for node in range(len(low)):
            own = x[rows_of(node)]
            assert (own.min(axis=0) == low[node]).all() and (own.max(axis=0) == high[node]).all()
        assert len(rows_of(len(low) - 1)) == n


def test_boxes_are_pruned_and_bounds_hold():
    r = np.random.default_rng(3)
    x = np.floor(256 * (r.normal(size=(12, 3))[np.arange(4000) % 12] + 0.05 * r.normal(size=(4000, 3)))).astype(np.int64)
    order, low, high, first, last, leaves = hardneg.pack_tree(x, 32)
    ids = np.arange(4000)
    tree = hardneg.Tree(common.pack(ids[order], ids[order], hardneg._narrow(x[order]).ravel(), hardneg._narrow(low).ravel(), hardneg._narrow(high).ravel(), first, last, np.array([leaves])), 3)
    q = x[17]
    least, most = tree.intervals(q)
    for node in range(leaves):
        s = x[order[first[node]:last[node]]] @ q
        assert least[node] <= s.min() and s.max() <= most[node]
    score = x @ q
    top = sorted((-s, i) for i, s in enumerate(score.tolist()) if i != 17)
    found, = tree.search(q, 17, [(hardneg.LOWEST, hardneg.HIGHEST, hardneg.LOWEST)], 5)
    assert [(-s, i) for s, i, _ in found] == top[:5] and tree.opened < leaves / 4
    kth, tree.opened = found[-1][0], 0
    # A bound from another block: rows equal to it stay, rows below it do not count.
    again, = tree.search(q, 17, [(hardneg.LOWEST, hardneg.HIGHEST, kth)], 5)
    assert again == found and tree.search(q, 17, [(hardneg.LOWEST, hardneg.HIGHEST, int(score.max()) + 1)], 5) == [[]]


def test_strides_visit_every_block_once():
    for n in range(1, 200):
        assert sorted(i * hardneg._stride(n) % n for i in range(n)) == list(range(n))
