"""Documents to chunks, chunk metadata and filters, sparse vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import each_token, tokens

# Room for this many chunks per document in an integer chunk id.
CHUNKS_PER_DOCUMENT = 1_000_000

#: Bytes of text whose terms one task counts: they set the memory it takes, whatever the size of the table.
TASK_BYTES = 8_000_000


def tasks_for(size: int | None) -> int:
    return max(1, -(-(size or 0) // TASK_BYTES))


def chunk_documents(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per entry of ``contents``: ``file_name, url, title, seq, content`` and ``keep``.

    ``seq`` starts at 0 in every document, and the title goes in front of the text. Chunks follow
    the given blocks; splitting on article numbers would also cut at citations.
    """
    # The outer form keeps Spark from computing the array once more to test its size.
    each = F.posexplode_outer("contents").alias("seq", "piece")
    pieces = documents.select(*keep, "file_name", "url", "title", each)
    return pieces.where(F.col("seq").isNotNull()).withColumn("content", F.concat_ws("\n", "title", "piece")).drop("piece")


def chunk_id(document_id: Column, seq: Column) -> Column:
    """Integer key of a chunk; fails if a document has more chunks than there is room for."""
    in_room = seq < CHUNKS_PER_DOCUMENT
    return F.when(in_room, document_id * CHUNKS_PER_DOCUMENT + seq).otherwise(
        F.raise_error("too many chunks in a document").cast("long")
    )


def with_metadata(chunks: DataFrame) -> DataFrame:
    """``content`` and a ``metadata`` struct of file name, url, title and seq."""
    fields = F.struct("file_name", "url", "title", "seq")
    return chunks.select("content", fields.alias("metadata"))


def title_has_token(chunks: DataFrame, token: str, title: str = "title") -> DataFrame:
    return chunks.where(F.array_contains(tokens(F.col(title)), token.lower()))


def seq_between(chunks: DataFrame, first: int, last: int) -> DataFrame:
    """Chunks whose position lies in a range; reaches the scan of a stored chunk table."""
    return chunks.where(F.col("seq").between(first, last))


def sparse_vectors(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Term table ``key, term, tf, dl``: the sparse vector of every text.

    Texts are spread by key once, to as many tasks as their bytes ask for. Counting terms, and whatever is later
    grouped by key, needs no further exchange.
    """
    size = texts.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("long"))).first()[0]
    words = texts.repartition(tasks_for(size), F.col(key)).select(key, tokens(F.col(text)).alias("words"))
    each = words.select(key, F.size("words").alias("dl"), each_token(F.col("words")).alias("term"))
    counted = each.where(F.col("term").isNotNull()).groupBy(key, "term").agg(
        F.count("*").alias("tf"), F.first("dl").cast("long").alias("dl")
    )
    return counted.select(key, "term", "tf", "dl")
