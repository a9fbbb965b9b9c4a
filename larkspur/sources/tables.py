"""The given parquet tables, CSV files of customers and scores, and QA sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customer CSV with a header; a file whose header disagrees with the schema fails."""
    return (
        spark.read.schema(schemas.CUSTOMERS)
        .options(header=True, enforceSchema=False, mode="FAILFAST")
        .csv(path)
    )


def write_scores(scores: DataFrame, path: str, key: str = "row_id", column: str = "score") -> None:
    """Score column as CSV. The row key goes along, since a distributed file set has no row order."""
    scores.select(key, column).write.mode("overwrite").option("header", True).csv(path)


def read_scores(spark: SparkSession, path: str, key: str = "row_id", column: str = "score") -> DataFrame:
    return (
        spark.read.schema(f"`{key}` long, `{column}` double")
        .options(header=True, enforceSchema=False)
        .csv(path)
    )


def questions_of(qa: DataFrame) -> DataFrame:
    return qa.select("question")


def answers_of(qa: DataFrame) -> DataFrame:
    return qa.select("answer")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Question/answer pairs stored as JSON lines."""
    return spark.read.schema(schemas.QUESTIONS).option("mode", "FAILFAST").json(path)


def conversation_questions(conversations: DataFrame) -> DataFrame:
    """Question/answer pairs: each user turn with the assistant turn right after it.

    The two sides meet on ``(conv_id, turn)``, a unique key, so one long conversation spreads
    over all tasks; a window per conversation would put it in one.
    """
    asked = conversations.where(F.col("role") == "user").select(
        "conv_id", F.col("turn"), F.col("text").alias("question")
    )
    answered = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(answered, ["conv_id", "turn"])
