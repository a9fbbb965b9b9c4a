import importlib
from collections import Counter

import pytest

import corpus_pipeline
from larkspur.llm import language, mixing, packing, private
from larkspur.llm.queries import ORACLES, QUERIES, vocabulary_path
from tests.llm.brute import jaccard_components

FOLDER = "/root/testdata/sf0.001"
BY_NAME = dict(corpus_pipeline.STAGES)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "private", "mixture", "packing"]
    assert importlib.import_module("__spark_entry__").queries()["pipeline"] is corpus_pipeline.run


def test_each_operator_has_a_query():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10
    assert set(ORACLES) <= set(QUERIES)


def test_stages_on_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    told = BY_NAME["language"](spark, docs, FOLDER)
    assert told.columns == columns
    accepted = {r["doc_id"] for r in language.identify(docs, language.learn_dictionaries(docs.where(~language.held_out()))).collect() if r["accepted"]}
    assert {r["doc_id"] for r in told.collect()} == accepted

    single = BY_NAME["near_copies"](spark, docs, FOLDER)
    expected = jaccard_components([(r["doc_id"], r["text"]) for r in rows], 5, 80, 100)
    assert {r["doc_id"] for r in single.collect()} == {i for i, (_, c) in expected.items() if i == c}

    masked = BY_NAME["private"](spark, docs, FOLDER)
    assert masked.columns == columns and masked.count() == len(rows)
    assert not [r for r in masked.collect() if [s for s in private.strict_spans(r["text"]) if s[3]]]
    assert all(r["n_chars"] == len(r["text"]) for r in masked.collect())

    mixed = BY_NAME["mixture"](spark, docs, FOLDER)
    assert mixed.columns == columns
    expected = Counter(r["doc_id"] for r in mixing.mix_sources(docs).collect())
    assert Counter(r["doc_id"] for r in mixed.collect()) == expected

    packed = BY_NAME["packing"](spark, docs, FOLDER).collect()
    assert sum(r["length"] for r in packed) == sum(len(packing.encoder(vocabulary_path())(r["text"])) + 1 for r in rows)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    key = lambda frame: Counter((r["doc_id"], r["doc_tokens"]) for r in frame.where("start = 0").collect())
    assert key(docs) == key(corpus_pipeline.run(spark, FOLDER))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_documents(documents, spark, name):
    texts = [None, "", " ", "the dog and the cat", "the dog and the cat", "x" * 100_000, "mail a@b.co now", "\n\n"]
    ids = [0, 1, 2, 3, 3, None, 6, 7]
    docs = documents(texts, ids=ids, lang=["en", None, "de", "en", "en", None, "en", ""], source=[None, "a", "a", "a", "a", "b", "", "c"])
    found = BY_NAME[name](spark, docs, FOLDER)
    found.collect()
    empty = BY_NAME[name](spark, documents([]), FOLDER)
    assert empty.count() == 0 and (name == "packing" or empty.columns == docs.columns)
    if name == "near_copies":
        kept = Counter(r["text"] for r in found.collect())
        assert kept == Counter(set(texts))
    if name == "private":
        assert {r["text"] for r in found.collect()} == {t.replace("a@b.co", "[EMAIL]") if t else t for t in texts}
    if name == "language":
        assert {r["doc_id"] for r in found.collect()} <= {3, None, 6}
