import math
import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import answering, retrieval, topk

VECTORS = "doc_id long, embedding array<double>"
QUERIES = "query_id long, embedding array<double>"
TEXTS = "doc_id long, text string"
ASKED = "query_id long, text string"


def hits(df, item="doc_id"):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r[item], r["score"]))
    return found


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def test_equal_scores_prefer_the_lower_id_and_void_vectors_are_no_hits(spark):
    corpus = spark.createDataFrame(
        [(5, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (6, None), (9, [0.0, 1.0])], VECTORS
    )
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None)], QUERIES)
    assert hits(retrieval.cosine_topk(queries, corpus)) == {1: [(3, 1.0), (5, 1.0), (9, 0.0)]}


@pytest.mark.parametrize("limits", [{}, {"query_limit": 3, "corpus_block": 20}])
def test_cosine_equals_brute_force_either_way(spark, limits):
    rng = random.Random(1)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(6)]
    items = [(i, vector()) for i in range(90)] + [(200 + i, [1.0] * 6) for i in range(30)]
    asked = [(i, vector()) for i in range(10)] + [(50, [1.0] * 6)]
    expected = {
        q: sorted(((i, round(cosine(v, w), 6)) for i, w in items), key=lambda h: (-h[1], h[0]))[:3]
        for q, v in asked
    }
    found = retrieval.cosine_topk(
        spark.createDataFrame(asked, QUERIES), spark.createDataFrame(items, VECTORS), **limits
    )
    assert hits(found) == expected


def bm25(asked, texts, k=3):
    words = {i: t.lower().split() for i, t in texts}
    average = sum(map(len, words.values())) / len(words)
    found = {}
    for q, text in asked:
        scores = []
        for i, w in words.items():
            score = 0.0
            for term in set(text.lower().split()):
                tf, df = w.count(term), sum(term in x for x in words.values())
                idf = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
                score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / average)) if tf else 0.0
            if score > 0:
                scores.append((i, round(score, 6)))
        if scores:
            found[q] = sorted(scores, key=lambda h: (-h[1], h[0]))[:k]
    return found


@pytest.mark.parametrize("limits", [{}, {"query_limit": 2, "corpus_block": 10}])
@pytest.mark.parametrize("piece", [8192, 5])
def test_bm25_equals_brute_force_either_way(spark, limits, piece, monkeypatch):
    monkeypatch.setattr(retrieval, "PIECE_TERMS", piece)
    rng = random.Random(2)
    pool = [f"w{i}" for i in range(30)]
    texts = [(i, " ".join(rng.choices(pool, k=rng.randint(1, 40)))) for i in range(60)]
    texts += [(100, ""), (101, "hot " * 500), (102, "hot")]
    asked = [(i, " ".join(rng.choices(pool, k=4))) for i in range(6)] + [(7, "hot hot"), (8, "unknown")]
    found = retrieval.bm25_topk(
        spark.createDataFrame(asked, ASKED), spark.createDataFrame(texts, TEXTS), **limits
    )
    assert hits(found) == bm25(asked, texts)


def test_hybrid_ranks_do_not_depend_on_the_partitions(spark):
    """Copies of a text and a vector tie wherever they lie, and come in the order of their ids."""
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(12)]
    kinds = [(" ".join(rng.choices(pool, k=rng.randint(3, 30))), [rng.uniform(-1, 1) for _ in range(64)]) for _ in range(40)]
    items = [(i, *kinds[i % 40]) for i in range(400)]
    asked = [(i, " ".join(rng.choices(pool, k=5)), [rng.uniform(-1, 1) for _ in range(64)]) for i in range(7)]
    corpus = spark.createDataFrame(items, "doc_id long, text string, embedding array<double>")
    queries = spark.createDataFrame(asked, "query_id long, text string, embedding array<double>")
    found = [
        sorted(tuple(r) for r in retrieval.hybrid_topk(queries, corpus.repartition(n, "doc_id"), k=5, **limits).collect())
        for n, limits in ((1, {}), (3, {}), (8, {}), (3, {"query_limit": 3, "corpus_block": 50}))
    ]
    assert found[0] == found[1] == found[2] == found[3]


def test_no_queries_give_no_hits(spark):
    texts = spark.createDataFrame([(1, "a")], TEXTS)
    assert retrieval.bm25_topk(spark.createDataFrame([], ASKED), texts).count() == 0
    vectors = spark.createDataFrame([(1, [1.0])], VECTORS)
    assert retrieval.cosine_topk(spark.createDataFrame([], QUERIES), vectors).count() == 0


def test_running_best_across_batches():
    import numpy as np

    best = topk._Best(1, 2)
    best.add(np.array([9, 4]), np.array([[0.5], [0.5]]))
    best.add(np.array([1]), np.array([[-np.inf]]))
    best.add(np.array([3]), np.array([[0.5]]))
    assert best.rows(np.array([7])).to_pydict() == {
        "query_id": [7, 7], "item_id": [3, 4], "score": [0.5, 0.5],
    }


def test_rank_fusion(spark):
    schema = "query_id long, doc_id long, rank int"
    dense = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], schema)
    sparse = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], schema)
    fused = hits(retrieval.fuse_ranks(dense, sparse))
    assert fused == {1: [(11, round(1 / 62 + 1 / 61, 6)), (10, round(1 / 61, 6)), (12, round(1 / 62, 6))]}


def test_queries_are_cut_by_terms_and_number():
    import pyarrow as pa

    table = pa.table({"terms": [["a"] * n for n in (9, 1, 1, 1, 3, 2)]})
    assert [p.num_rows for p in retrieval._pieces(table, 4, 2)] == [1, 2, 2, 1]


@pytest.mark.parametrize("limit", [0, 10])
def test_texts_join_either_way(spark, limit, collect):
    found = spark.createDataFrame([(1, 7, 0.5, 1)], "query_id long, doc_id long, score double, rank int")
    texts = spark.createDataFrame([(7, "x"), (8, "y")], TEXTS)
    joined = answering.with_texts(found, texts, limit=limit).select("query_id", "doc_id", "text")
    assert collect(joined) == [(1, 7, "x")]


def test_embedding_hook(spark):
    texts = spark.createDataFrame([(1, "ab"), (2, "abcd")], TEXTS)
    embedded = retrieval.embed(texts, lambda batch: batch.map(lambda t: [float(len(t)), 1.0]))
    assert [r["embedding"] for r in embedded.orderBy("doc_id").collect()] == [[2.0, 1.0], [4.0, 1.0]]


def test_contexts_prompt_and_fixed_answer(spark):
    found = spark.createDataFrame(
        [(1, 7, 2, "second. More here"), (1, 9, 1, "first {question}")],
        "query_id long, doc_id long, rank int, text string",
    )
    asked = spark.createDataFrame([(1, "what more?"), (2, "nothing")], "query_id long, question string")
    rows = answering.attach_contexts(asked, answering.contexts(found))
    answered = answering.add_extractive_answer(answering.add_prompt(rows)).orderBy("query_id").collect()
    one, two = answered
    assert one["context"] == "first {question}\nsecond. More here" and one["sources"] == [9, 7]
    assert one["prompt"].count("first {question}\nsecond. More here") == 2
    assert "Question:\nwhat more?" in one["prompt"]
    assert one["response"] == "More here" and two["response"] == answering.NOTHING_FOUND
    assert two["context"] is None and "Context:\n\n" in two["prompt"]


def test_answer_hook(spark):
    rows = spark.createDataFrame([(1, "abc")], "query_id long, prompt string")
    found = answering.answer_with(rows, lambda batch: batch["prompt"].str.upper())
    assert found.first()["response"] == "ABC"


def test_weak_hits_are_dropped(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.4)], "doc_id long, score double")
    assert answering.drop_weak_hits(df, 0.5).select(F.col("doc_id")).collect() == [(1,)]
