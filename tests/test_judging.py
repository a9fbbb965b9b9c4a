import pytest
from pyspark.sql import functions as F

from larkspur.operators import judging

ROW = "query_id long, user_input string, response string, reference string, retrieved_contexts array<string>"


def by_query(df, column):
    return {r["query_id"]: r[column] for r in df.collect()}


def test_context_precision(spark):
    df = spark.createDataFrame(
        [(1, 1, 1), (1, 2, 0), (1, 3, 1), (2, 1, 0), (2, 2, 0), (2, 3, 0)],
        "query_id long, rank int, verdict int",
    )
    found = by_query(judging.context_precision(df), "context_precision")
    assert found == {1: pytest.approx(0.833333, abs=1e-6), 2: 0.0}


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [
            (1, "who steals", "He steals. Moon cheese", "he steals. it rains", ["he steals a lot", "sun"]),
            (2, "q", "a", "r", None),
            (3, "q", None, "r", ["r"]),
            (4, "...", "...", "...", ["x"]),
        ],
        ROW,
    )


def test_shares_of_supported_statements(rows):
    assert by_query(judging.faithfulness(rows), "faithfulness") == {1: 0.5, 2: 0.0, 3: 0.0, 4: 0.0}
    assert by_query(judging.context_recall(rows), "context_recall") == {1: 0.5, 2: 0.0, 3: 1.0, 4: 0.0}


def test_verdicts(rows):
    found = judging.context_verdicts(rows.where("query_id = 1")).orderBy("rank").collect()
    assert [(r["rank"], r["verdict"]) for r in found] == [(1, 1), (2, 0)]


def test_lexical_relevancy(rows):
    found = by_query(judging.answer_relevancy(rows), "answer_relevancy")
    assert found[1] == pytest.approx(1 / (2**0.5 * 4**0.5)) and found[2] == 0.0 and found[4] == 0.0


def test_vector_relevancy(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], [1.0, 0.0]), (1, [1.0, 0.0], [0.0, 2.0])],
        "query_id long, question_vector array<double>, generated_vector array<double>",
    )
    assert by_query(judging.vector_relevancy(df), "answer_relevancy") == {1: 0.5}


def test_incomplete_rows_are_errors_with_zeros(rows):
    scores = judging.evaluate(rows)
    assert by_query(scores, "error") == {1: False, 2: True, 3: True, 4: False}
    for name in judging.SCORES:
        assert by_query(scores, name)[3] == 0.0
    means = judging.mean_scores(scores).first()
    assert (means["rows"], means["errors"]) == (4, 2)


def test_evaluation_rows_keep_unanswered_questions(spark):
    questions = spark.createDataFrame([(1, "a"), (2, "b")], "query_id long, question string")
    references = spark.createDataFrame([(1, "r")], "query_id long, reference string")
    answers = spark.createDataFrame([(1, "x", ["c"])], "query_id long, response string, contexts array<string>")
    found = judging.evaluation_rows(questions, references, answers).orderBy("query_id").collect()
    assert [tuple(r) for r in found] == [(1, "a", "r", "x", ["c"]), (2, "b", None, None, None)]


def test_judge_hook(spark, rows):
    judged = judging.judge_with(
        rows.select("query_id"), lambda b: b.assign(verdict=b["query_id"] % 2), "query_id long, verdict long"
    )
    assert judged.agg(F.sum("verdict")).first()[0] == 2
