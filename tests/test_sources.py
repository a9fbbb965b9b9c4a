import json

import pytest
from pyspark.sql import functions as F

from larkspur.operators import corpus
from larkspur.session import fresh_folder, shared_folder
from larkspur.sources import collections, documents, tables

HEADER = (
    "customer_id,credit_score,country,gender,age,tenure,balance,products_number,"
    "credit_card,active_member,estimated_salary,churn"
)


def test_customer_csv(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text(f"{HEADER}\n1,600,France,Female,42,2,0.0,1,1,1,101348.88,1\n")
    row = tables.read_customers(spark, str(path)).first()
    assert (row["country"], row["balance"], row["churn"]) == ("France", 0.0, 1)


def test_customer_csv_with_other_header_fails(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text(HEADER.replace("age", "years") + "\n1,600,France,Female,42,2,0.0,1,1,1,1.0,1\n")
    with pytest.raises(Exception):
        tables.read_customers(spark, str(path)).collect()


def test_score_csv_keeps_keys(spark, tmp_path, collect):
    scores = spark.createDataFrame([(2, 0.5), (1, 0.25)], "row_id long, score double")
    tables.write_scores(scores, str(tmp_path / "s"))
    assert collect(tables.read_scores(spark, str(tmp_path / "s"))) == [(1, 0.25), (2, 0.5)]


def write(folder, name, content):
    (folder / f"{name}.json").write_text(content, encoding="utf-8")


def test_document_folder_is_validated(spark, tmp_path, collect):
    good = {"title": "형법", "contents": ["제1조", "제2조"], "url": "u"}
    write(tmp_path, "형법 1+a%20", json.dumps(good, indent=4))
    write(tmp_path, "empty", json.dumps({**good, "contents": []}))
    write(tmp_path, "number", json.dumps({**good, "title": 1}))
    write(tmp_path, "flat", json.dumps({**good, "contents": "제1조"}))
    write(tmp_path, "missing", json.dumps({"title": "t", "contents": []}))
    write(tmp_path, "broken", '{"title": ')
    for name, rest in (("rest", " x"), ("second", json.dumps(good)), ("bracket", "] ["), ("comma", "," + json.dumps(good))):
        write(tmp_path, name, json.dumps(good) + rest)
    (tmp_path / "other.txt").write_text("x")
    loose = documents.read_documents(spark, str(tmp_path), strict=False)
    assert collect(loose.select("file_name", "title", "contents")) == [
        ("empty", "형법", []),
        ("형법 1+a%20", "형법", ["제1조", "제2조"]),
    ]
    assert collect(documents.rejected_documents(spark, str(tmp_path))) == [
        ("bracket", "broken"),
        ("broken", "broken"),
        ("comma", "broken"),
        ("flat", "contents wrong type"),
        ("missing", "url missing"),
        ("number", "title wrong type"),
        ("rest", "broken"),
        ("second", "broken"),
    ]
    with pytest.raises(Exception):
        documents.read_documents(spark, str(tmp_path)).collect()


def test_latest_per_key_and_json_sink(spark, tmp_path, collect):
    df = spark.createDataFrame(
        [(1, "a", ["x"], "u1"), (2, "b", [], "u2"), (3, "a", ["y"], "u3")],
        "page_id long, title string, contents array<string>, url string",
    )
    latest = documents.latest_per_key(df, "title", "page_id")
    assert sorted(r["page_id"] for r in latest.collect()) == [2, 3]
    documents.write_documents(latest, str(tmp_path / "d"))
    more = spark.createDataFrame([("b", ["z"], "u4"), ("c", [], "u5")], "title string, contents array<string>, url string")
    documents.write_documents(more, str(tmp_path / "d"))
    read = documents.read_documents(spark, str(tmp_path / "d"))
    assert collect(read.select("title", "contents", "url")) == [("a", ["y"], "u3"), ("b", ["z"], "u4"), ("c", [], "u5")]
    documents.write_documents(latest, str(tmp_path / "d"))
    documents.write_documents(spark.createDataFrame([(None, ["n"], "u6")], more.schema), str(tmp_path / "d"))
    documents.write_documents(spark.createDataFrame([(None, ["n"], "u7")], more.schema), str(tmp_path / "d"))
    nulls = df.select(F.lit(None).cast("string").alias("title"), "page_id")
    assert documents.latest_per_key(nulls, "title", "page_id").count() == 3
    back = spark.read.schema("title string, contents array<string>, url string").json(str(tmp_path / "d"))
    assert sorted(r["url"] for r in back.collect()) == ["u2", "u3", "u5", "u6", "u7"]


def law(spark):
    return spark.createDataFrame(
        [
            ("f1", "u1", "형법", ["제1조 제2조를 따른다", "제2조"]),
            ("f2", "u2", "빈 법", []),
            ("f3", "u3", "소송법", ["제1조"]),
        ],
        "file_name string, url string, title string, contents array<string>",
    )


def test_chunks_restart_and_keep_citations(spark, collect):
    chunks = corpus.chunk_documents(law(spark))
    assert collect(chunks.select("file_name", "seq", "content")) == [
        ("f1", 0, "형법\n제1조 제2조를 따른다"),
        ("f1", 1, "형법\n제2조"),
        ("f3", 0, "소송법\n제1조"),
    ]
    metadata = corpus.with_metadata(chunks).where("metadata.seq = 1").first()["metadata"]
    assert tuple(metadata) == ("f1", "u1", "형법", 1)
    assert corpus.title_has_token(chunks, "형법").count() == 2
    assert corpus.seq_between(chunks, 1, 5).count() == 1


def test_collection_is_replaced_and_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "c")
    chunks = corpus.chunk_documents(law(spark))
    sparse = corpus.sparse_vectors(chunks.select("file_name", F.col("content").alias("text")), "file_name")
    collections.create_collection(path, chunks.union(chunks), sparse=sparse)
    collections.create_collection(path, chunks, sparse=sparse)
    opened = collections.open_collection(spark, path)
    assert opened.count() == 3
    plan = corpus.seq_between(opened, 1, 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(seq,1)" in plan and "LessThanOrEqual(seq,2)" in plan
    assert collections.open_collection(spark, path, "sparse").columns == ["file_name", "term", "tf", "dl"]


def test_terms_are_counted_by_as_many_tasks_as_texts_need(spark, collect, monkeypatch):
    rows = [(i % 90, f"a b{i} a") for i in range(100)] + [(None, "a"), (None, "a c"), (200, None), (201, "")]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    whole = collect(corpus.sparse_vectors(texts, "doc_id"))
    assert (None, "a", 2) in [row[:3] for row in whole] and (5, "a", 4, 3) in whole
    monkeypatch.setattr(corpus, "TASK_BYTES", 20)
    spread = corpus.sparse_vectors(texts, "doc_id")
    assert collect(spread) == whole
    assert spread.rdd.getNumPartitions() > 20


def test_tables_made_from_the_stored_chunks(spark, tmp_path, collect):
    path = str(tmp_path / "c")
    chunks = corpus.chunk_documents(law(spark))
    collections.create_collection(path, chunks, sparse=lambda stored: corpus.sparse_vectors(stored, "file_name", "content"))
    expected = corpus.sparse_vectors(chunks, "file_name", "content")
    assert collect(collections.open_collection(spark, path, "sparse")) == collect(expected)


def test_questions_json(spark, tmp_path, collect):
    (tmp_path / "qa.json").write_text('{"question": "q1", "answer": "a1"}\n')
    qa = tables.read_questions(spark, str(tmp_path / "qa.json"))
    assert collect(tables.questions_of(qa)) == [("q1",)] and collect(tables.answers_of(qa)) == [("a1",)]


def test_chunk_id_refuses_overflow(spark):
    with pytest.raises(Exception, match="too many chunks"):
        spark.range(1).select(corpus.chunk_id(F.lit(1), F.lit(1_000_000))).collect()


def test_shared_folder_follows_the_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
