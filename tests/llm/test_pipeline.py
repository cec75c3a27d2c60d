"""The pipeline's stages against the operators' brute-force versions, and the
registered queries against DuckDB."""

import os
import random

import brute
import pytest
from test_jaccard import groups

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from editpulse.llm import registry, toxicity
from editpulse.session import scratch_dir
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    r = random.Random(3)
    rows = [(i, t, "en", "s", len(t or "")) for i, t in brute.corpus(9, n=40)]
    bad = ["idiot", "moron", "clown"]
    rows += [(1000 + i, " ".join(r.choice(["ab", "cde", "f"] + bad) for _ in range(40)), "en", "s", 9) for i in range(60)]
    labels = [(i, int(i >= 1000)) for i, *_ in rows]
    folder = scratch_dir(spark, "pipeline-test")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")

    one = pipeline.drop_toxic(spark, docs, folder)
    scored = {x.doc_id for x in toxicity.score_documents(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect() if not x.predicted}
    left = [(x.doc_id, x.text) for x in one.collect()]
    assert {i for i, _ in left} == scored == {i for i, *_ in rows if i < 1000} and one.columns == docs.columns

    two = pipeline.drop_near_copies(spark, one, folder)
    kept = sorted(((x.doc_id, x.text or "") for x in two.collect()))
    want = groups(left)
    assert [i for i, _ in kept] == sorted(i for i, (_, root) in want.items() if root == i) and two.columns == docs.columns

    three = pipeline.cut_repeats(spark, two, folder)
    removed = brute.bytes_removed(kept)
    got = {x.doc_id: x for x in three.collect()}
    assert three.columns == docs.columns and set(got) == set(removed)
    for i, (n_bytes, n_removed, _, digest) in removed.items():
        text = got[i].text.encode()
        assert got[i].n_chars == len(got[i].text) and got[i].lang == "en"
        # a character cut in two goes as a whole: at most three bytes at each edge
        assert brute.sha(text) == digest or (n_removed and len(text) < n_bytes - n_removed)

    pieces = pipeline.run(spark, folder).collect()
    assert {p.doc_id for p in pieces} == set(got)
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)


def test_stages_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    folder = scratch_dir(spark, "pipeline-empty")
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_entry_has_every_operator():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in registry.queries()}
    assert set(registry.queries()) <= set(entry.queries()) and set(registry.oracle_sql()) < set(registry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    info = compare(spark, duck(SF), SF, name, registry.queries()[name], registry.oracle_sql()[name])
    assert info["match"], info
