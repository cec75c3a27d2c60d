"""Operator 11 against brute force."""

import random
from collections import defaultdict

import brute
import pytest

from editpulse.llm import linededup

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_kept(rows, min_length=40, min_documents=5):
    """``doc_id -> (n_lines, n_dropped, text left)`` of rows with distinct ids."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    held, out = defaultdict(set), {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_length:
                held[key(line)].add(i)
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= min_documents and max(held[key(x)]) != i)]
        out[i] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return out


def corpus(seed=2, n=80):
    r = random.Random(seed)
    line = lambda k: "".join(r.choice("abcXYZ éÄ中 .") for _ in range(k)).strip(BLANKS + " ")
    shared = [line(60) for _ in range(6)] + ["q" * 40, "q" * 39, "É" * 45, "a" + " " * 45 + "b", line(50).upper()]
    texts = []
    for _ in range(n):
        out = []
        for _ in range(r.randint(0, 9)):
            x = r.choice(shared) if r.random() < 0.5 else line(r.randint(0, 80))
            x = x.translate(LOWER) if r.random() < 0.3 else x
            out.append(r.choice(["", " ", "\t\r", "\x0b\x0c"]) + x + r.choice(["", "  ", "\r"]))
        texts.append(r.choice(["\n", "\n\n", "\n \n"]).join(out) + r.choice(["", "\n"]))
    texts += [None, "", "\n", "\n\n\n", shared[0], "\n".join([shared[1]] * 7), "\n".join(shared * 300)]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("hot", [2000, 1, 10**6])
def test_line_dedup_equals_brute_force(docs_of, hot):
    rows = corpus()
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in linededup.without_common_lines(docs_of(rows), hot_share=hot).collect()}
    want = lines_kept(rows)
    assert got == want and sum(w[1] for w in want.values()) > 300


def test_hot_lines_are_dealt_over_salts(docs_of):
    x = "the line that every document of this table holds"
    lines = linededup.key_lines(linededup.C.keyed(docs_of([(i, x) for i in range(50)] + [(99, "y" * 40)])))
    over = linededup.common_keys(lines, 1).cache()
    assert over.count() == 2
    left, right = linededup._salted(lines, over, 2000)
    assert left.where("salt > 0").count() > 40 and right.count() > 1000
    assert left.join(right, ["k1", "k2", "salt"]).count() == 51


def test_line_dedup_null_ids_repeated_rows_and_empty_table(docs_of):
    x = "The line that every document of this table holds"
    rows = [(1, x + "\na"), (2, x), (3, x), (3, x), (3, "b\n" + x), (4, " " + x.lower()), (None, x), (None, None)]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in linededup.without_common_lines(docs_of(rows)).collect()), key=str)
    assert got == sorted([(1, 2, 1, "a"), (2, 1, 1, ""), (3, 1, 1, ""), (3, 1, 1, ""), (3, 2, 1, "b"), (4, 1, 1, ""), (None, 1, 0, x), (None, 1, 0, "")], key=str)
    four = [(3, x)] * 9 + [(3, "b\n" + x), (4, x), (5, x), (6, x)]
    assert {r.n_dropped for r in linededup.without_common_lines(docs_of(four)).collect()} == {0}
    none = linededup.without_common_lines(docs_of([(1, "a")]).where("false"))
    assert none.count() == 0 and none.columns == ["doc_id", "n_lines", "n_dropped", "text"]


def test_a_very_long_text_of_short_lines(docs_of):
    x = "the line that every document of this table holds"
    rows = [(i, x) for i in range(6)] + [(10, "\n".join([x, "z"] * 100_000)), (11, x)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, brute.sha(r.text.encode())) for r in linededup.without_common_lines(docs_of(rows)).collect()}
    assert got == {i: (a, b, brute.sha(t.encode())) for i, (a, b, t) in lines_kept(rows).items()}
