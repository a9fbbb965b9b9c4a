"""Retrieval and answer quality over ``benchmark``, ``documents``, ``conversations``, ``embeddings``.

A benchmark item's first sentence is the question and the rest its reference answer. In
conversations, the user's turn is the question and the only context of the assistant's answer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.text import sentences
from larkspur.functions.vectors import as_double
from larkspur.operators import answering, judging, retrieval
from larkspur.plans.pages import conversation_questions
from larkspur.plans.registry import query
from larkspur.plans.retrieval import ITEM_SQL, TEXT_SQL, bm25_sql, sentences_sql, tokens_sql
from larkspur.session import shared_folder
from larkspur.sources.tables import table


def _split_items(spark, folder):
    listed = sentences(F.col("text"))
    rest = F.slice(listed, F.lit(2), F.greatest(F.size(listed) - 1, F.lit(0)))
    reference = F.when(F.size(listed) > 1, F.array_join(rest, ". ")).otherwise(F.col("text"))
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.get(listed, F.lit(0)).alias("question"),
        reference.alias("reference"),
    )


def benchmark_rows(spark, folder):
    """Evaluation rows of the benchmark: retrieve once, answer from what was found."""
    items = _split_items(spark, folder)
    docs = table(spark, folder, "documents")
    asked = items.select("query_id", F.col("question").alias("text"))
    hits = retrieval.bm25_topk(asked, docs)
    found = answering.contexts(answering.with_texts(hits, docs))
    answered = answering.add_extractive_answer(
        answering.attach_contexts(items.select("query_id", "question"), found)
    )
    return judging.evaluation_rows(items, items, answered)


def _stored_rows(spark, folder):
    """Evaluation rows written once, since four scores read them: retrieval runs a single time."""
    shared_folder(spark)
    return benchmark_rows(spark, folder).checkpoint()


SPLIT_SQL = f"""split AS (SELECT item_id AS query_id, {sentences_sql('text')} AS s, text FROM benchmark),
    items AS (SELECT query_id, s[1] AS question,
        CASE WHEN len(s) > 1 THEN array_to_string(s[2:], '. ') ELSE text END AS reference FROM split)"""

ROWS_SQL = (
    "WITH "
    + SPLIT_SQL
    + ","
    + bm25_sql("SELECT query_id, question AS text FROM items", TEXT_SQL, "doc_id")
    + f""", hits AS (SELECT ranked.*, text FROM ranked JOIN documents USING (doc_id)
        WHERE rank <= 3),
    pieces AS (SELECT query_id, rank, {sentences_sql('text')} AS s FROM hits),
    listed AS (SELECT query_id, rank, unnest(s) AS sentence, unnest(range(len(s))) AS place FROM pieces),
    shares AS (SELECT l.query_id, sentence, rank, place,
        len(list_intersect(list_distinct({tokens_sql('question')}), {tokens_sql('sentence')}))
        / len(list_distinct({tokens_sql('question')})) AS share
        FROM listed l JOIN items i ON l.query_id = i.query_id),
    best AS (SELECT query_id, sentence FROM shares
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY share DESC, rank, place) = 1),
    rows AS (SELECT i.query_id, question AS user_input, reference,
        coalesce(sentence, '{answering.NOTHING_FOUND}') AS response, n FROM items i
        LEFT JOIN best USING (query_id)
        LEFT JOIN (SELECT query_id, count(*) AS n FROM hits GROUP BY query_id) USING (query_id))"""
)


def share_sql(part: str, whole: str) -> str:
    distinct = f"list_distinct({tokens_sql(part)})"
    return f"coalesce(len(list_intersect({distinct}, {tokens_sql(whole)})) / nullif(len({distinct}), 0), 0)"


VERDICT_SQL = f""", verdicts AS (SELECT query_id, rank,
    CAST({share_sql('reference', 'text')} >= 0.5 AS INTEGER) AS verdict
    FROM hits JOIN rows USING (query_id)),
precisions AS (SELECT query_id, coalesce(sum(p * verdict) / nullif(sum(verdict), 0), 0)
    AS context_precision FROM (SELECT *, avg(verdict) OVER (PARTITION BY query_id ORDER BY rank) AS p
    FROM verdicts) GROUP BY query_id)"""


def _support_sql(name: str, text: str) -> str:
    return f""", {name}_s AS (SELECT query_id, {sentences_sql(text)} AS s FROM rows WHERE n > 0),
    {name}_l AS (SELECT query_id, unnest(s) AS st, unnest(range(len(s))) AS pos FROM {name}_s),
    {name}_v AS (SELECT query_id, pos, max(CAST({share_sql('st', 'text')} >= 0.5 AS INTEGER)) AS ok
        FROM {name}_l JOIN hits USING (query_id) GROUP BY query_id, pos),
    {name} AS (SELECT r.query_id, coalesce(avg(ok), 0) AS {name} FROM {name}_s r
        LEFT JOIN {name}_v v USING (query_id) GROUP BY r.query_id)"""


RECALL_SQL = _support_sql("context_recall", "reference")
FAITH_SQL = _support_sql("faithfulness", "response")


def _terms_sql(source: str, keys: str, left: str, right: str) -> str:
    return f""", qa_words AS (
        SELECT {keys}, unnest({tokens_sql(left)}) AS term, 1 AS l, 0 AS r FROM {source}
        UNION ALL SELECT {keys}, unnest({tokens_sql(right)}) AS term, 0, 1 FROM {source}),
    tf AS (SELECT {keys}, term, sum(l)::BIGINT AS l, sum(r)::BIGINT AS r FROM qa_words GROUP BY ALL),
    cos AS (SELECT {keys}, coalesce(sum(l * r) / nullif(sqrt(sum(l * l)::DOUBLE) * sqrt(sum(r * r)::DOUBLE), 0), 0)
        AS answer_relevancy FROM tf GROUP BY ALL),
    relevancy AS (SELECT {keys}, coalesce(answer_relevancy, 0) AS answer_relevancy
        FROM {source} LEFT JOIN cos USING ({keys}))"""


@query(
    "evaluation_rows",
    ROWS_SQL
    + """, c AS (SELECT query_id, string_agg(text, ' || ' ORDER BY rank) AS contexts FROM hits GROUP BY 1)
    SELECT query_id, user_input, reference, response, contexts FROM rows LEFT JOIN c USING (query_id)""",
)
def evaluation_rows(spark, folder):
    rows = benchmark_rows(spark, folder)
    return rows.withColumn("contexts", F.array_join("retrieved_contexts", " || ")).drop(
        "retrieved_contexts"
    )


@query("context_verdicts", ROWS_SQL + VERDICT_SQL + "SELECT * FROM verdicts")
def context_verdicts(spark, folder):
    return judging.context_verdicts(benchmark_rows(spark, folder))


@query(
    "context_precision",
    ROWS_SQL
    + VERDICT_SQL
    + """SELECT query_id, round(coalesce(context_precision, 0), 6) AS context_precision
    FROM rows LEFT JOIN precisions USING (query_id)""",
)
def context_precision(spark, folder):
    rows = _stored_rows(spark, folder)
    scored = judging.context_precision(judging.context_verdicts(rows), rows=rows)
    return scored.withColumn("context_precision", F.round("context_precision", 6))


@query(
    "context_recall",
    ROWS_SQL
    + RECALL_SQL
    + """SELECT query_id, round(coalesce(context_recall, 0), 6) AS context_recall
    FROM rows LEFT JOIN context_recall USING (query_id)""",
)
def context_recall(spark, folder):
    scored = judging.context_recall(benchmark_rows(spark, folder))
    return scored.withColumn("context_recall", F.round("context_recall", 6))


SCORES_SQL = (
    ROWS_SQL
    + VERDICT_SQL
    + RECALL_SQL
    + FAITH_SQL
    + ", full_rows AS (SELECT * FROM rows WHERE n > 0)"
    + _terms_sql("full_rows", "query_id", "user_input", "response")
    + """, scores AS (SELECT query_id, coalesce(faithfulness, 0) AS faithfulness,
        coalesce(context_recall, 0) AS context_recall,
        coalesce(answer_relevancy, 0) AS answer_relevancy,
        coalesce(context_precision, 0) AS context_precision, n IS NULL AS error
    FROM rows LEFT JOIN faithfulness USING (query_id) LEFT JOIN context_recall USING (query_id)
    LEFT JOIN relevancy USING (query_id) LEFT JOIN precisions USING (query_id))"""
)


@query(
    "evaluation_scores",
    SCORES_SQL
    + "SELECT query_id, "
    + ", ".join(f"round({name}, 6) AS {name}" for name in judging.SCORES)
    + ", error FROM scores",
)
def evaluation_scores(spark, folder):
    scores = judging.evaluate(_stored_rows(spark, folder))
    return scores.withColumns({name: F.round(name, 6) for name in judging.SCORES})


@query(
    "evaluation_means",
    SCORES_SQL
    + "SELECT "
    + ", ".join(f"round(avg({name}), 6) AS {name}" for name in judging.SCORES)
    + ', count(*) AS "rows", count(*) FILTER (error) AS errors FROM scores',
)
def evaluation_means(spark, folder):
    """Overall means, with the number of rows and of errors."""
    means = judging.mean_scores(judging.evaluate(_stored_rows(spark, folder)))
    return means.withColumns({name: F.round(name, 6) for name in judging.SCORES})


CONVERSATION_SQL = """WITH pairs AS (SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer
    FROM conversations q JOIN conversations a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
    WHERE q.role = 'user' AND a.role = 'assistant')"""

CONVERSATION_KEYS = ("conv_id", "turn")


def _conversation_rows(spark, folder):
    return conversation_questions(spark, folder).select(
        *CONVERSATION_KEYS,
        F.col("question").alias("user_input"),
        F.col("answer").alias("response"),
        F.array("question").alias("retrieved_contexts"),
    )


@query(
    "conversation_faithfulness",
    CONVERSATION_SQL
    + f""", l AS (SELECT conv_id, turn, question, unnest({sentences_sql('answer')}) AS st FROM pairs),
    v AS (SELECT conv_id, turn, avg(CAST({share_sql('st', 'question')} >= 0.5 AS INTEGER)) AS f
        FROM l GROUP BY ALL)
    SELECT conv_id, turn, round(coalesce(f, 0), 6) AS faithfulness
    FROM pairs LEFT JOIN v USING (conv_id, turn)""",
)
def conversation_faithfulness(spark, folder):
    scored = judging.faithfulness(_conversation_rows(spark, folder), keys=CONVERSATION_KEYS)
    return scored.withColumn("faithfulness", F.round("faithfulness", 6))


@query(
    "conversation_relevancy",
    CONVERSATION_SQL
    + _terms_sql("pairs", "conv_id, turn", "question", "answer")
    + "SELECT conv_id, turn, round(answer_relevancy, 6) AS answer_relevancy FROM relevancy",
)
def conversation_relevancy(spark, folder):
    scored = judging.answer_relevancy(_conversation_rows(spark, folder), keys=CONVERSATION_KEYS)
    return scored.withColumn("answer_relevancy", F.round("answer_relevancy", 6))


@query(
    "vector_relevancy",
    """SELECT a.vec_id AS query_id, round(avg(list_cosine_similarity(a.embedding::DOUBLE[],
        b.embedding::DOUBLE[])), 6) AS answer_relevancy
    FROM embeddings a JOIN embeddings b ON b.vec_id BETWEEN a.vec_id + 1 AND a.vec_id + 3
    GROUP BY a.vec_id""",
)
def vector_relevancy(spark, folder):
    """Each vector as a question, the next three as those regenerated from its answer."""
    stored = table(spark, folder, "embeddings").select(
        "vec_id", as_double(F.col("embedding")).alias("embedding")
    )
    steps = F.explode(F.sequence(F.lit(1), F.lit(3))).alias("step")
    asked = stored.select("vec_id", F.col("embedding").alias("question_vector"), steps)
    generated = stored.select(
        F.col("vec_id").alias("other"), F.col("embedding").alias("generated_vector")
    )
    pairs = asked.join(generated, F.col("vec_id") + F.col("step") == F.col("other")).withColumnRenamed(
        "vec_id", "query_id"
    )
    scored = judging.vector_relevancy(pairs)
    return scored.withColumn("answer_relevancy", F.round("answer_relevancy", 6))


@query(
    "judged_rows",
    CONVERSATION_SQL
    + """SELECT conv_id, turn, CAST(length(answer) > length(question) AS INTEGER) AS verdict FROM pairs""",
)
def judged_rows(spark, folder):
    """The judge hook: verdicts from a batch function instead of the lexical rule."""
    rows = _conversation_rows(spark, folder).select(*CONVERSATION_KEYS, "user_input", "response")

    def longer(batch):
        verdict = (batch["response"].str.len() > batch["user_input"].str.len()).astype("int32")
        return batch[list(CONVERSATION_KEYS)].assign(verdict=verdict)

    return judging.judge_with(rows, longer, "conv_id long, turn long, verdict int")
