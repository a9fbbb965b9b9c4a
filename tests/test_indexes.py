import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import inverted, retrieval, vectorindex
from larkspur.session import fresh_folder
from larkspur.sources import snapshots


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(3)
    words = [f"w{int(draw.paretovariate(0.7)) % 300}" for _ in range(6000)]
    rows = [(i, " ".join(words[draw.randrange(5900) :][: draw.randint(1, 60)])) for i in range(300)]
    rows += [(900, ""), (901, None), (902, "!?"), (903, rows[5][1]), (904, rows[5][1])]
    return spark.createDataFrame(rows, "doc_id long, text string").persist()


@pytest.fixture(scope="module")
def questions(spark, texts):
    rows = [(1, "w1 w2 w3"), (2, "W7 w250"), (3, "nothing known"), (4, ""), (5, None), (6, " ".join(f"w{i}" for i in range(200)))]
    return spark.createDataFrame(rows, "query_id long, text string")


def rows_of(df):
    return sorted(map(tuple, df.select("query_id", "doc_id", "score", "rank").collect()))


@pytest.mark.parametrize("block_texts", [1, 16, 100_000])
@pytest.mark.parametrize("k", [1, 3, 400])
def test_index_finds_what_a_scan_finds(spark, texts, questions, block_texts, k):
    index = inverted.build_index(texts, fresh_folder(spark, "index"), block_texts=block_texts)
    for idf in (True, False):
        assert rows_of(inverted.search(questions, index, k, idf)) == rows_of(retrieval.bm25_topk(questions, texts.where("text IS NOT NULL"), k, idf=idf))


def test_blocks_below_the_bar_are_not_read(spark, texts, questions, monkeypatch):
    index = inverted.build_index(texts, fresh_folder(spark, "index"), block_texts=4)
    seen = []
    real = inverted.rank_hits
    monkeypatch.setattr(inverted, "rank_hits", lambda hits, k, item: seen.append(hits.count()) or real(hits, k, item))
    inverted.search(questions.where("query_id = 2"), index, 1)
    held = texts.where(F.expr("exists(split(text, ' '), w -> w IN ('w7', 'w250'))")).count()
    assert seen[-1] < held  # rows of the last ranking: the best of the first blocks, and texts of later ones


def test_search_reads_the_partitions_of_its_terms(spark, texts, questions, monkeypatch):
    monkeypatch.setattr(inverted, "PARTITION_POSTINGS", 50)
    index = inverted.build_index(texts, fresh_folder(spark, "index"))
    assert index.facts["parts"] > 10
    terms = spark.createDataFrame([("w7",), ("w250",)], "term string")
    rows = inverted.wanted_postings(index, terms)
    assert {r["term"] for r in rows.collect()} <= {"w7", "w250"} and rows.select("part").distinct().count() <= 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "part#" in plan.split("PartitionFilters")[1]
    monkeypatch.setattr(inverted, "PUSHED_TERMS", 0)
    assert sorted(map(str, inverted.wanted_postings(index, terms).select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
    assert rows_of(inverted.search(questions, index, 2)) == rows_of(retrieval.bm25_topk(questions, texts.where("text IS NOT NULL"), 2))


def test_blocks_keep_ties_and_questions_go_in_slices(spark, texts, questions, monkeypatch):
    copies = spark.range(1000, 1040).select(F.col("id").alias("doc_id"), F.lit("w1 w2 w3").alias("text"))
    several = texts.where("text IS NOT NULL").unionByName(copies)
    monkeypatch.setattr(inverted, "SLICE_QUERIES", 2)
    index = inverted.build_index(several, fresh_folder(spark, "index"), block_texts=64)
    assert rows_of(inverted.search(questions, index, 5)) == rows_of(retrieval.bm25_topk(questions, several, 5))


def test_texts_move_once_and_hits_of_a_block_stay_few(spark, texts, questions, monkeypatch):
    index = inverted.build_index(texts, fresh_folder(spark, "index"), block_texts=64)
    assert {"items", "tfs", "dls"} <= set(index.table("postings").columns)
    seen = []
    real = inverted.rank_hits
    monkeypatch.setattr(inverted, "rank_hits", lambda hits, k, item: seen.append(hits.count()) or real(hits, k, item))
    inverted.search(questions.where("query_id = 6"), index, 1)
    assert seen[0] <= 2 * inverted.FIRST_BLOCKS  # 300 texts hold a term


def test_index_of_nothing(spark, texts, questions):
    index = inverted.build_index(texts.limit(0), fresh_folder(spark, "index"))
    assert inverted.search(questions, index).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    draw = random.Random(8)
    heads = [[draw.gauss(0, 1) for _ in range(12)] for _ in range(9)]
    rows = [(i, [x + draw.gauss(0, 0.4) for x in heads[i % 9]]) for i in range(700)]
    rows += [(900, [0.0] * 12), (901, None), (902, [None, *[1.0] * 11]), (903, [float("nan")] * 12), (904, rows[3][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").persist()


def test_all_lists_give_the_exact_result_and_few_give_most(spark, vectors, monkeypatch):
    monkeypatch.setattr(vectorindex, "PIECE", 30)
    index = vectorindex.build_index(vectors, fresh_folder(spark, "vectors"))
    queries = vectors.where("vec_id % 20 = 0 AND vec_id < 900").select(F.col("vec_id").alias("query_id"), "embedding")
    clean = vectors.where("vec_id < 900 OR vec_id = 904")
    exact = {tuple(r) for r in retrieval.cosine_topk(queries, clean, 5, "vec_id").collect()}
    assert {tuple(r) for r in vectorindex.search(queries, index, 5, probes=len(index.facts["centres"])).collect()} == exact
    few = {tuple(r)[:2] for r in vectorindex.search(queries, index, 5).collect()}
    assert len(few & {t[:2] for t in exact}) >= 0.9 * len(exact)
    assert index.facts["probes"] < len(index.facts["centres"])
    assert index.table("lists").count() == index.facts["vectors"] == 701
    assert index.table("sizes").agg(F.max("pieces")).first()[0] > 1


def test_only_probed_lists_are_scanned(spark, vectors):
    index = vectorindex.build_index(vectors, fresh_folder(spark, "vectors"), lists=6)
    asked = spark.createDataFrame([(1, 2), (2, 4)], "query_id long, list int")
    rows = vectorindex.probed_lists(index, asked)
    assert {r["list"] for r in rows.select("list").distinct().collect()} <= {2, 4}
    assert "PartitionFilters: [list" in rows._jdf.queryExecution().executedPlan().toString()


def test_vector_index_of_nothing(spark, vectors):
    index = vectorindex.build_index(vectors.limit(0), fresh_folder(spark, "vectors"))
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    assert vectorindex.search(queries, index).count() == 0


def test_a_write_that_dies_leaves_the_state_before(spark):
    path = fresh_folder(spark, "state")
    assert snapshots.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        snapshots.open_snapshot(spark, path)
    good, bad = spark.range(3), spark.range(5).select(F.raise_error(F.lit("dies")).cast("long").alias("id"))
    snapshots.write_snapshot(spark, path, {"a": good, "b": good}, facts={"n": 3})
    with pytest.raises(Exception, match="dies"):
        snapshots.write_snapshot(spark, path, {"a": spark.range(9), "b": bad})
    now = snapshots.open_snapshot(spark, path)
    assert (now.version, now.facts, now.table("a").count(), now.table("b").count()) == (0, {"n": 3}, 3, 3)
    reader = now.table("a")
    again = snapshots.write_snapshot(spark, path, {"a": spark.range(7)})
    assert again.version == 1 and reader.count() == 3
    assert snapshots.remove_old(spark, path) == 2
    assert snapshots.open_snapshot(spark, path).table("a").count() == 7
