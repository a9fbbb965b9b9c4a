"""Quality of retrieval and answers: assembly of evaluation rows and the four scores.

A verdict is an input column wherever one is at hand (a judge's decision, say). The default is
lexical: a statement counts as supported by a text that holds a given share of its tokens.
``keys`` identify an evaluation row; every score keeps one row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.numeric import ratio_or_zero
from larkspur.functions.text import containment, sentences, tokens
from larkspur.functions.vectors import cosine

SUPPORT = 0.5
KEYS = ("query_id",)
SCORES = ("faithfulness", "context_recall", "answer_relevancy", "context_precision")


def evaluation_rows(
    questions: DataFrame, references: DataFrame, answers: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Align question, reference and the answer with its contexts by key.

    A question without a reference or an answer stays, with NULLs.
    """
    keys = list(keys)
    return (
        questions.select(*keys, F.col("question").alias("user_input"))
        .join(references.select(*keys, "reference"), keys, "left")
        .join(answers.select(*keys, "response", F.col("contexts").alias("retrieved_contexts")), keys, "left")
    )


def context_verdicts(
    rows: DataFrame, support: float = SUPPORT, keys: Sequence[str] = KEYS
) -> DataFrame:
    """``keys, rank, verdict``: whether each retrieved context supports the reference."""
    wanted = rows.withColumn("__reference", tokens(F.col("reference")))
    each = wanted.select(*keys, "__reference", F.posexplode("retrieved_contexts").alias("rank", "text"))
    share = containment(F.col("__reference"), tokens(F.col("text")))
    return each.select(*keys, (F.col("rank") + 1).alias("rank"), (share >= support).cast("int").alias("verdict"))


def context_precision(verdicts: DataFrame, keys: Sequence[str] = KEYS, rows: DataFrame | None = None) -> DataFrame:
    """Mean precision at the ranks of supporting contexts; 0 if none supports.

    A window holds one row's contexts only, as many as were retrieved. ``rows`` that have no context at
    all have 0 too; without them only keys with a verdict are scored.
    """
    so_far = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    at_rank = F.avg("verdict").over(so_far)
    scored = (
        verdicts.withColumn("__p", at_rank * F.col("verdict"))
        .groupBy(*keys)
        .agg(ratio_or_zero(F.sum("__p"), F.sum("verdict")).alias("context_precision"))
    )
    if rows is None:
        return scored
    return rows.select(*keys).join(scored, list(keys), "left").fillna(0.0, ["context_precision"])


def supported_share(
    rows: DataFrame,
    statements: Column,
    texts: Column,
    out: str,
    support: float = SUPPORT,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Share of ``statements`` (array) that at least one of ``texts`` (array) supports.

    Texts are tokenised once each, ahead of the statements; without statements the share is 0.
    """
    keys = list(keys)
    by_text = rows.select(*keys, statements.alias("__s"), F.explode_outer(texts).alias("__text"))
    words = by_text.select(*keys, "__s", tokens(F.col("__text")).alias("__words"))
    pairs = words.select(*keys, "__words", F.posexplode_outer("__s").alias("__pos", "__statement"))
    share = containment(tokens(F.col("__statement")), F.col("__words"))
    judged = pairs.select(*keys, "__pos", F.coalesce((share >= support).cast("int"), F.lit(0)).alias("__ok"))
    return (
        judged.groupBy(*keys, "__pos")
        .agg(F.max("__ok").alias("__ok"))
        .groupBy(*keys)
        .agg(F.avg("__ok").alias(out))
    )


def context_recall(
    rows: DataFrame, support: float = SUPPORT, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Share of the reference's sentences found in the retrieved contexts."""
    return supported_share(
        rows, sentences(F.col("reference")), F.col("retrieved_contexts"), "context_recall", support, keys
    )


def faithfulness(
    rows: DataFrame, support: float = SUPPORT, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Share of the response's sentences found in the retrieved contexts."""
    return supported_share(
        rows, sentences(F.col("response")), F.col("retrieved_contexts"), "faithfulness", support, keys
    )


def answer_relevancy(
    rows: DataFrame,
    left: str = "user_input",
    right: str = "response",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Cosine of the term-frequency vectors of question and answer; 0 if a side has no token.

    Both groupings share their leading keys, so one exchange serves both.
    """
    keys = list(keys)

    def side(text: str, first: int) -> Column:
        words = F.coalesce(tokens(F.col(text)), F.array().cast("array<string>"))
        return F.transform(
            words,
            lambda t: F.struct(t.alias("term"), F.lit(first).alias("l"), F.lit(1 - first).alias("r")),
        )

    words = F.concat(side(left, 1), side(right, 0))
    counted = (
        rows.select(*keys, F.explode_outer(words).alias("w"))
        .groupBy(*keys, F.col("w.term").alias("term"))
        .agg(F.sum("w.l").alias("l"), F.sum("w.r").alias("r"))
    )
    lengths = F.sqrt(F.sum(F.col("l") * F.col("l")).cast("double")) * F.sqrt(
        F.sum(F.col("r") * F.col("r")).cast("double")
    )
    overlap = F.sum(F.col("l") * F.col("r"))
    return counted.groupBy(*keys).agg(ratio_or_zero(overlap, lengths).alias("answer_relevancy"))


def vector_relevancy(pairs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean cosine of a question's vector and those of the questions regenerated from its answer.

    ``pairs`` hold ``question_vector`` and ``generated_vector``, one row per regenerated question.
    """
    similarity = cosine(F.col("question_vector"), F.col("generated_vector"))
    return pairs.groupBy(*keys).agg(F.avg(similarity).alias("answer_relevancy"))


def combine_scores(
    rows: DataFrame, *scores: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """All scores of a row side by side. If one is missing, ``error`` is set and all are 0."""
    combined = rows.select(*keys)
    for score in scores:
        combined = combined.join(score, list(keys), "left")
    names = [c for c in combined.columns if c not in keys]
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(name).isNull()
    values = [F.when(F.col("error"), F.lit(0.0)).otherwise(F.col(n)).alias(n) for n in names]
    return combined.withColumn("error", missing).select(*keys, *values, "error")


def evaluate(rows: DataFrame, support: float = SUPPORT, keys: Sequence[str] = KEYS) -> DataFrame:
    """The four scores per evaluation row; an incomplete row is an error with zeros."""
    complete = rows.where(
        F.col("response").isNotNull()
        & F.col("reference").isNotNull()
        & F.col("user_input").isNotNull()
        & (F.size(F.coalesce("retrieved_contexts", F.array().cast("array<string>"))) > 0)
    )
    return combine_scores(
        rows,
        faithfulness(complete, support, keys),
        context_recall(complete, support, keys),
        answer_relevancy(complete, keys=keys),
        context_precision(context_verdicts(complete, support, keys), keys, complete),
        keys=keys,
    )


def mean_scores(scores: DataFrame) -> DataFrame:
    """One row: the mean of every score, the number of rows and of errors."""
    return scores.agg(
        *[F.avg(name).alias(name) for name in SCORES],
        F.count("*").alias("rows"),
        F.count_if("error").alias("errors"),
    )


def judge_with(
    rows: DataFrame, judge: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Scores or verdicts from a user-given batch function with a declared result schema."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield judge(batch)

    return rows.mapInPandas(run, schema)
