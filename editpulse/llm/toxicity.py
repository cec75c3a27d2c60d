"""Toxicity scores from a lexicon that is matched despite misspellings
(operator 10).

The lexicon is learned from a bounded sample of labelled documents: word
beginnings that occur almost only in toxic ones, each as long as it can be
without losing its support; one that mostly ends the word is a whole term, the
others are stems.  The terms form a trie.  A word's Levenshtein automaton (bit
sets of positions reached with no error, and with one) is intersected with the
trie, so one walk finds all terms within an edit; a stem matches any
continuation.  Each distinct word of a batch is matched once.

Ordinary words are not misspellings: a word within an edit of a term (of a stem:
the beginning that is) counts only if those of the sample's documents that hold
it are toxic nearly as a rule, as a term's are, or none holds it.

A hit counts as quoted if its word carries quotation marks, or if marks or
words of reporting stand within the window around it; quotation weighs less
than abuse.  Counts of direct, misspelled and quoted hits give the score
through a logistic model fitted on the same sample; as far as the sample does
not tell, a misspelled hit weighs as a direct one, and never less than nothing.

Defined results: null text: empty, the score of no hit; null ``doc_id``: held
out; labels that are null or whose document is missing are not used, of several
for one id the greatest counts; without any usable label every score is 0;
repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import common as C

#: Labelled documents learned from, the least by hash of their id; a bound on
#: what is fitted, not on what is scored.
SAMPLE_DOCS = 10_000
#: Toxic documents a term needs (at least, and as a share of all toxic ones of the
#: sample), and its least share of toxic ones.
LEAST_TOXIC = 8
LEAST_SHARE = 0.01
PURITY = 0.9
MAX_TERMS = 5_000
SHORTEST, LONGEST = 3, 12
#: A term matches with one edit from this length on.
FUZZY_LENGTH = 5
#: Words before and after a hit that can mark it as quoted.
CONTEXT_WORDS = 3

# Quotation marks and words of reporting.
QUOTES = "\"“”„«»‹›"
REPORTING = ("said", "says", "word", "words", "term", "quote", "quoted", "called", "insult", "slur")

NONE, DIRECT, FUZZY = 0, 1, 2
QUOTED, MARK = 4, 8
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


class Lexicon:
    """A trie of terms; ``match`` intersects it with a word's automaton."""

    def __init__(self, terms: list[tuple[str, bool]], fuzzy_length: int = FUZZY_LENGTH, ordinary: frozenset[str] = frozenset()):
        """``terms``: text and whether it is a stem (matches any continuation);
        ``ordinary``: what ``found`` names that is no misspelling."""
        self.root: dict = {}
        self.ordinary = ordinary
        for term, stem in terms:
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            # the end of a term: is a stem, may have an edit
            old = node.get("", (False, False))
            node[""] = (old[0] or stem, len(term) >= fuzzy_length)

    def match(self, word: str) -> int:
        """``DIRECT`` for a term, ``FUZZY`` for one with an edit that is no ordinary
        word, else ``NONE``."""
        direct, near = self.found(word)
        return DIRECT if direct else FUZZY if near - self.ordinary else NONE

    def found(self, word: str) -> tuple[bool, set[str]]:
        """Whether the word is a term, and else what of it is a term with an edit:
        the word, with a blank behind it, or for a stem its least such beginning."""
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        full = 1 << len(word)
        near, stack = set(), [(self.root, 1, 3)]
        while stack:
            node, exact, edited = stack.pop()
            for c, child in node.items():
                if c == "":
                    stem, fuzzy = child
                    if exact & full or (stem and exact):
                        return True, set()
                    # a stem's edit must lie inside it: its first letter stands
                    if fuzzy and stem and edited:
                        near.add(word[:(edited & -edited).bit_length() - 1])
                    elif fuzzy and edited & full:
                        near.add(word + " ")
                    continue
                m = masks.get(c, 0)
                one = (exact & m) << 1
                # a wrong letter, a missing one and one too many
                two = ((edited & m) << 1) | exact << 1 | exact | one << 1
                two &= (full << 1) - 1
                if one | two:
                    stack.append((child, one, two))
        return False, near

    def classify(self, unit: str) -> int:
        """Bits of a word as it stands in a text, with its punctuation."""
        word = _EDGES.sub("", unit.lower())
        code = self.match(word) if len(word) >= SHORTEST else NONE
        if any(q in unit for q in QUOTES):
            code |= QUOTED
        if word in REPORTING:
            code |= MARK
        return code


def features(batch: pa.RecordBatch, lexicon: Lexicon, known: dict, window: int = CONTEXT_WORDS) -> np.ndarray:
    """Direct, misspelled and quoted hits of each text, a row each."""
    out = np.zeros((len(batch), 3))
    data, offsets = C.buffers(batch["text"])
    for i, j in C.slices(offsets, 4 << 20):
        own = data[offsets[i]:offsets[j]]
        start, end, first = C.words_of(own, offsets[i:j + 1] - offsets[i])
        if not len(start):
            continue
        # a word with the white space behind it; stripped when looked at
        edges = np.append(start, len(own)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(own))]).dictionary_encode()
        if len(known) > 500_000:  # bounds the task's memory; a word is matched again
            known.clear()
        codes = []
        for unit in units.dictionary.to_pylist():
            code = known.get(unit)
            if code is None:
                code = known[unit] = lexicon.classify(unit.decode(errors="replace").strip())
            codes.append(code)
        code = np.array(codes, np.int64)[units.indices.to_numpy()]
        kind = code & 3
        hits = np.flatnonzero(kind)
        text = np.searchsorted(first, hits, "right") - 1
        quoted = (code[hits] & QUOTED) > 0
        for step in [*range(-window, 0), *range(1, window + 1)]:
            near = hits + step
            inside = (near >= first[text]) & (near < first[text + 1])
            quoted |= inside & ((code[np.clip(near, 0, len(code) - 1)] & (QUOTED | MARK)) > 0)
        for column, chosen in ((0, (kind[hits] == DIRECT) & ~quoted), (1, (kind[hits] == FUZZY) & ~quoted), (2, quoted)):
            np.add.at(out[:, column], i + text[chosen], 1)
    return np.log1p(out)


def _word_counts():
    """Per task: documents of each class that hold a word."""
    schema = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def words(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["toxic"].to_pylist()):
                for w in {_EDGES.sub("", u) for u in text.decode(errors="replace").lower().split()}:
                    if len(w) >= SHORTEST:
                        counts.setdefault(w, [0, 0])[0 if toxic else 1] += 1
            if len(counts) > 500_000:
                yield C.table(schema, list(counts), *zip(*counts.values()))
                counts = {}
        if counts:
            yield C.table(schema, list(counts), *zip(*counts.values()))

    return words


def count_words(labelled: DataFrame) -> DataFrame:
    """``word, toxic, clean``: documents of each class that hold a word."""
    counts = labelled.mapInArrow(_word_counts(), "word string, toxic bigint, clean bigint")
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def ordinary_words(words: DataFrame, terms: list[tuple[str, bool]]) -> frozenset[str]:
    """What of the counted words is a term with an edit (``Lexicon.found``), but not
    as pure as a term must be."""
    schema = pa.schema([("near", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def near(batches):
        lexicon = Lexicon(terms)
        for batch in batches:
            out = [(n, toxic, clean) for word, toxic, clean in zip(*(batch[c].to_pylist() for c in ("word", "toxic", "clean"))) for n in lexicon.found(word)[1]]
            if out:
                yield C.table(schema, *zip(*out))

    counts = words.mapInArrow(near, "near string, toxic bigint, clean bigint").groupBy("near").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return frozenset(r["near"] for r in counts.where(F.col("toxic") < PURITY * (F.col("toxic") + F.col("clean"))).collect())  # of the sample's words


def learn_terms(labelled: DataFrame, words: DataFrame) -> list[tuple[str, bool]]:
    """Terms from ``(text, toxic)`` rows and their ``count_words``: text and whether it is a stem."""
    least = max(LEAST_TOXIC, LEAST_SHARE * labelled.where("toxic > 0").count())
    cut = words.select("toxic", "clean", F.explode(F.expr(
        f"concat(transform(sequence({SHORTEST}, least({LONGEST}, char_length(word))), k -> substring(word, 1, k)), array(concat(substring(word, 1, {LONGEST}), '$')))")).alias("start"))
    rows = cut.groupBy("start").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(
        (F.col("toxic") >= least) & (F.col("toxic") >= PURITY * (F.col("toxic") + F.col("clean"))))
    support = {r["start"]: r["toxic"] for r in rows.orderBy(F.desc("toxic"), "start").limit(MAX_TERMS * LONGEST).collect()}  # bounded
    terms, longer = [], {}
    for s in support:
        longer.setdefault(s[:-1], []).append(s)
    for start in sorted(support, key=lambda s: (len(s), s)):
        if start.endswith("$") or start[:-1] in support:
            continue  # a term's continuation
        while True:  # as long as it keeps nine tenths of its support
            more = [s for s in longer.get(start, ()) if support[s] >= 0.9 * support[start]]
            if not more:
                terms.append((start, True, support[start]))
                break
            if more[0].endswith("$"):
                terms.append((start, False, support[start]))
                break
            start = more[0]
    terms.sort(key=lambda t: (-t[2], t[0]))
    return [(t, stem) for t, stem, _ in terms[:MAX_TERMS]]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic model (the last: constant), by Newton's method.  The
    ridge draws a misspelled hit's weight to a direct one's, and it is at least 0;
    quoted hits that the sample never shows get half the weight of a direct hit."""
    w = _newton(np.column_stack([x[:, 0] + x[:, 1], x[:, 1:], np.ones(len(x))]), y, ridge)
    w[1] += w[0]
    if w[1] < 0:  # then the best one that is not negative is 0
        w = np.insert(_newton(np.column_stack([x[:, 0], x[:, 2:], np.ones(len(x))]), y, ridge), 1, 0.0)
    if not x[:, 2].any():
        w[2] = w[0] / 2
    return w


def _newton(a: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip((a * w).sum(axis=1), -30, 30)))
        hessian = np.einsum("ni,nj,n->ij", a, a, p * (1 - p)) + ridge * np.eye(len(w)) * len(y) ** 0.5
        step = np.linalg.solve(hessian, (a * (y - p)[:, None]).sum(axis=0) - ridge * len(y) ** 0.5 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _featured(lexicon: Lexicon):
    schema = pa.schema([("f", pa.list_(pa.float64())), ("toxic", pa.int32())])

    def featured(batches):
        known: dict = {}
        for batch in batches:
            if len(batch):
                yield C.table(schema, features(batch, lexicon, known).tolist(), batch["toxic"])

    return featured


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[Lexicon, list[float]]:
    """Lexicon and weights from labelled documents outside the held-out fifth."""
    doc_id = F.col("doc_id").cast("bigint")
    usable = labels.select(doc_id.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null").where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    sample = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    labelled = C.staged(docs.sparkSession, docs.select(doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(sample), "doc_id").select("text", "toxic"), "labelled").dropDuplicates()  # at most sample_docs ids are broadcast
    words = C.staged(docs.sparkSession, count_words(labelled), "labelled-words")
    terms = learn_terms(labelled, words)
    lexicon = Lexicon(terms, ordinary=ordinary_words(words, terms))
    rows = labelled.mapInArrow(_featured(lexicon), "f array<double>, toxic int").collect()  # three numbers a labelled text
    y = np.array([r["toxic"] > 0 for r in rows], float)
    if not len(y) or y.min() == y.max():
        return lexicon, []
    return lexicon, fit(np.array([r["f"] for r in rows]), y).tolist()


def _scored(lexicon, weights, columns: list[pa.Field]):
    schema = pa.schema([*columns, ("score", pa.float64())])

    def scored(batches):
        known, w = {}, np.array(weights)
        for batch in batches:
            if not len(batch):
                continue
            score = np.zeros(len(batch))
            if len(w):
                score = 1 / (1 + np.exp(-np.clip(features(batch, lexicon, known) @ w[:-1] + w[-1], -700, 700)))
            yield C.table(schema, *(batch[c.name] for c in columns), score)

    return scored


def score_documents(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per document ``doc_id, id, h`` (``common.keyed``), ``held_out``, ``score``, ``predicted``."""
    lexicon, weights = train(docs, labels, sample_docs)
    fields = [pa.field("doc_id", pa.int64()), pa.field("id", pa.int64()), pa.field("h", pa.int64())]
    scored = C.keyed(docs).mapInArrow(_scored(lexicon, weights, fields), "doc_id bigint, id bigint, h bigint, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return scored.select("doc_id", "id", "h", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows, with all their columns, that score under ``threshold``."""
    lexicon, weights = train(docs, labels, sample_docs)

    def clean(batches):
        known, w = {}, np.array(weights)
        for batch in batches:
            if len(w) and len(batch):
                score = 1 / (1 + np.exp(-np.clip(features(batch, lexicon, known) @ w[:-1] + w[-1], -700, 700)))
                batch = batch.filter(pa.array(score < threshold))
            yield batch

    return docs.mapInArrow(clean, docs.schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    found = score_documents(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")
