"""A collection: chunk, sparse-vector, dense-vector and index tables side by side under one path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.sources.snapshots import open_snapshot, remove_old, write_snapshot


def create_collection(path: str, chunks: DataFrame, **vectors: DataFrame | Callable[[DataFrame], DataFrame]) -> None:
    """Create or replace all tables at once; what an earlier load left is deleted once the new state stands.

    A table given as a function is made from the chunks as they were stored, which saves computing them again.
    """
    spark = chunks.sparkSession
    made = {name: rows if isinstance(rows, DataFrame) else (lambda state, rows=rows: rows(state.table("chunks"))) for name, rows in vectors.items()}
    write_snapshot(spark, path, {"chunks": chunks, **made})
    remove_old(spark, path)


def open_collection(spark: SparkSession, path: str, part: str = "chunks") -> DataFrame:
    """Attach to one table of an existing collection."""
    return open_snapshot(spark, path).table(part)
