"""From ranked hits to context text, prompt and answer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import containment, sentences, tokens
from larkspur.session import shared_folder

PROMPT = """You look up criminal-law articles. Answer the question from the context alone.

- Show the context you used with the answer: {context}
- Without context, or for another field of law, say that nothing was found and suggest an expert.
- State what the law says and add no opinion.

Context:
{context}

Question:
{question}
"""

BROADCAST_HITS = 200_000

NOTHING_FOUND = "No matching law was found. Please consult an expert."


def with_texts(
    hits: DataFrame, texts: DataFrame, item_id: str = "doc_id", limit: int = BROADCAST_HITS
) -> DataFrame:
    """Add the text of every hit.

    The hits are stored first. Up to ``limit`` of them go to wherever the texts are, which then
    stay in place; more than that meet the texts in an ordinary join.
    """
    shared_folder(hits.sparkSession)
    stored = hits.checkpoint()
    few = stored.limit(limit + 1).count() <= limit
    return texts.select(item_id, "text").join(F.broadcast(stored) if few else stored, item_id)


def contexts(hits: DataFrame, item_id: str = "doc_id") -> DataFrame:
    """One row per query: ordered ``contexts`` and ``sources`` arrays and the joined ``context``."""
    entry = F.struct("rank", F.col(item_id).alias("source"), "text")
    ordered = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return ordered.select(
        "query_id",
        F.col("e.text").alias("contexts"),
        F.col("e.source").alias("sources"),
        F.array_join("e.text", "\n").alias("context"),
    )


def drop_weak_hits(hits: DataFrame, minimum: float) -> DataFrame:
    return hits.where(F.col("score") >= minimum)


def attach_contexts(questions: DataFrame, found: DataFrame) -> DataFrame:
    """Questions with their contexts; a question without hits keeps NULLs."""
    return questions.join(found, "query_id", "left")


def fill_template(template: str, **slots: Column) -> Column:
    """Replace every ``{name}`` in a template by a column; NULL slots become empty text.

    The template is cut at its slots first, so text that looks like a slot stays as it is.
    """
    parts: list[Column] = []
    rest = template
    while rest:
        spots = [(rest.find("{" + name + "}"), name) for name in slots]
        spots = [spot for spot in spots if spot[0] >= 0]
        if not spots:
            parts.append(F.lit(rest))
            break
        start, name = min(spots)
        if start:
            parts.append(F.lit(rest[:start]))
        parts.append(F.coalesce(slots[name], F.lit("")))
        rest = rest[start + len(name) + 2 :]
    return F.concat(*parts)


def add_prompt(rows: DataFrame, template: str = PROMPT) -> DataFrame:
    filled = fill_template(template, context=F.col("context"), question=F.col("question"))
    return rows.withColumn("prompt", filled)


def best_sentence(question: Column, texts: Column) -> Column:
    """The sentence holding the largest share of the question's tokens; the earliest if equal.

    The question's tokens are bound to a lambda's variable, so that they are computed once for all sentences.
    """
    listed = F.flatten(F.transform(texts, sentences))

    def best(wanted: Column) -> Column:
        scored = F.transform(
            listed,
            lambda s, i: F.struct(containment(wanted, tokens(s)).alias("share"), (-i).alias("place"), s.alias("text")),
        )
        return F.array_max(scored)["text"]

    return F.get(F.transform(F.array(tokens(question)), best), F.lit(0))


def add_extractive_answer(rows: DataFrame, out: str = "response") -> DataFrame:
    """Default answer: the best matching context sentence, or a fixed text without context."""
    answer = best_sentence(F.col("question"), F.col("contexts"))
    return rows.withColumn(out, F.coalesce(answer, F.lit(NOTHING_FOUND)))


def answer_with(
    rows: DataFrame, answer: Callable[[pd.DataFrame], pd.Series], out: str = "response"
) -> DataFrame:
    """Answers from a user-given batch function (a hosted model, say) over the prompt rows."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{out: answer(batch)})

    return rows.mapInPandas(run, schema)


