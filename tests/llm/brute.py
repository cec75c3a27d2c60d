"""Brute-force versions of the operators and the cases they are tested on."""

import hashlib
import random
import re

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def corpus(seed=3, n=60, vocabulary=400, length=160):
    """Texts with exact copies, near copies, shared passages, repeats inside a
    text, empty and null texts, and long runs of one byte."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéñ中") for _ in range(r.randint(1, 7)))
    words = [word() for _ in range(vocabulary)]
    prose = lambda k: " ".join(r.choice(words) for _ in range(k))
    passages = [prose(r.randint(55, 90)) for _ in range(3)]
    texts = []
    for i in range(n):
        kind = r.random()
        if kind < 0.15 and texts:
            texts.append(r.choice(texts))
        elif kind < 0.35 and texts:
            w = (r.choice(texts) or "").split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[r.randrange(len(w))] = word()
            texts.append(" ".join(w))
        elif kind < 0.55:
            texts.append(prose(r.randint(5, 60)) + "\n" + r.choice(passages) + "\t" + prose(r.randint(0, 60)))
        elif kind < 0.62:
            p = prose(70)
            texts.append(p + " \n " + p + " x " + p)
        elif kind < 0.68:
            texts.append(prose(r.randint(0, 4)))
        else:
            texts.append(prose(r.randint(20, length)))
    texts += [None, "", " \n\t ", "a" * 700, "a" * 350, "ab " * 90, None]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts))


def words_removed(rows, window=50):
    """Operator 8 over ``(doc_id, text)`` rows with distinct ids."""
    first, docs = {}, {}
    for i, t in rows:
        docs[i] = w = WORDS.findall((t or "").encode())
        for a in range(len(w) - window + 1):
            k = tuple(w[a:a + window])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, w in docs.items():
        gone = set()
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < i:
                gone.update(range(a, a + window))
        out[i] = (len(w), len(gone), sha(b" ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def bytes_removed(rows, window=100):
    """Operator 2 over ``(doc_id, text)`` rows with distinct ids."""
    first, docs = {}, {}
    for i, t in sorted(rows):
        docs[i] = b = (t or "").encode()
        for a in range(len(b) - window + 1):
            first.setdefault(b[a:a + window], (i, a))
    out = {}
    for i, b in docs.items():
        gone = bytearray(len(b))
        for a in range(len(b) - window + 1):
            if first[b[a:a + window]] != (i, a):
                gone[a:a + window] = b"\1" * window
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out[i] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out
