"""Dense, sparse and hybrid retrieval."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import each_token, token_set, tokens
from larkspur.operators.topk import Scorer, exact_ranks, rank_hits, topk_join
from larkspur.session import shared_folder, spread

# Number of retrieved chunks; usual BM25 and rank-fusion parameters.
TOP_K = 3
K1 = 1.2
B = 0.75
FUSION_OFFSET = 60

# Size limits of one dense weight table.
PIECE_TERMS = 8192
PIECE_QUERIES = 512


def embed(texts: DataFrame, encode: Callable[[pd.Series], pd.Series], text: str = "text") -> DataFrame:
    """Add ``embedding`` through a user-given batch function from texts to vectors."""
    encoder = F.pandas_udf(encode, "array<double>")
    return texts.withColumn("embedding", encoder(F.col(text)))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Unit-length rows; vectors of length zero become NaN."""
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) == 0:
        return np.zeros((0, 0))
    matrix = values.reshape(len(flat), -1)
    lengths = np.sqrt((matrix * matrix).sum(axis=1))
    lengths[lengths == 0] = np.nan
    return matrix / lengths[:, None]


def _cosine_scorer(queries: pa.Table) -> Scorer:
    wanted = _matrix(queries.column("embedding"))

    def score(items: pa.Table) -> np.ndarray:
        if items.num_rows == 0 or queries.num_rows == 0:
            return np.zeros((items.num_rows, queries.num_rows))
        similarity = _matrix(items.column("embedding")) @ wanted.T
        return np.where(np.isnan(similarity), -np.inf, similarity)

    return score


def cosine_topk(
    queries: DataFrame, corpus: DataFrame, k: int = TOP_K, item_id: str = "doc_id", **limits
) -> DataFrame:
    """The k items of highest cosine per query: ``query_id, <item_id>, score, rank``.

    Both sides carry ``embedding``. Missing vectors and vectors of length zero match nothing.
    """
    queries = queries.select("query_id", "embedding").where(F.col("embedding").isNotNull())
    corpus = corpus.select(item_id, "embedding").where(F.col("embedding").isNotNull())
    return topk_join(queries, corpus, _cosine_scorer, k, item_id, **limits)


def term_statistics(corpus: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, df, length`` for the wanted ``terms`` and, under the empty term, the whole corpus.

    No token is empty, so that row counts all texts (``df``) and all tokens (``length``): document
    frequencies and corpus size come from one pass over the texts. Occurrences are counted where they
    are before anything is joined, so a frequent term is a row per task, not one per text.
    """
    spark = corpus.sparkSession
    whole = spark.range(1).select(F.lit("").alias("term"))
    wanted = terms.select("term").distinct().unionByName(whole)
    marked = F.array_append(F.array_distinct("words"), "")
    occurrences = corpus.select(F.size("words").alias("dl"), F.explode(marked).alias("term"))
    own_length = F.when(F.col("term") == "", F.col("dl")).otherwise(0)
    counted = occurrences.groupBy("term").agg(F.count("*").alias("df"), F.sum(own_length).alias("length"))
    return counted.join(wanted, "term")


def query_weights(queries: DataFrame, corpus: DataFrame, idf: bool = True) -> DataFrame:
    """``query_id, terms, weights, avgdl``: each query as a sparse vector."""
    exploded = queries.select("query_id", each_token(token_set(F.col("text"))).alias("term"))
    terms = exploded.where(F.col("term").isNotNull())
    shared_folder(queries.sparkSession)
    # Two readers want different columns of this, which would count the corpus twice. The result
    # has one row per query term, so it is stored.
    statistics = term_statistics(corpus, terms).checkpoint()
    size = statistics.where(F.col("term") == "").select(F.struct("df", "length").alias("s")).scalar()
    weighted = terms.join(statistics, "term").withColumn("s", size)
    rarity = F.log(1 + (F.col("s.df") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = rarity if idf else F.lit(1.0)
    entry = F.struct("term", weight.alias("weight"))
    grouped = weighted.groupBy("query_id").agg(
        F.sort_array(F.collect_list(entry)).alias("e"),
        F.max(F.try_divide(F.col("s.length").cast("double"), F.col("s.df"))).alias("avgdl"),
    )
    return grouped.select(
        "query_id",
        F.col("e.term").alias("terms"),
        F.col("e.weight").alias("weights"),
        "avgdl",
    )


def _pieces(queries: pa.Table, most_terms: int, most_queries: int) -> Iterator[pa.Table]:
    """Slices of the queries whose weight table, terms by queries, stays small."""
    counts = pc.list_value_length(queries.column("terms")).to_pylist()
    start, entries = 0, 0
    for position, count in enumerate(counts):
        full = entries + count > most_terms or position - start >= most_queries
        if full and position > start:
            yield queries.slice(start, position - start)
            start, entries = position, 0
        entries += count
    yield queries.slice(start)


def _piece_scorer(queries: pa.Table, k1: float, b: float) -> Scorer:
    terms = queries.column("terms").combine_chunks()
    vocabulary = pc.unique(terms.flatten())
    width = len(vocabulary)
    term_index = pc.index_in(terms.flatten(), value_set=vocabulary).to_numpy(zero_copy_only=False)
    owner = pc.list_parent_indices(terms).to_numpy()
    weights = np.zeros((width, queries.num_rows))
    weights[term_index, owner] = (
        queries.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    )
    average = queries.column("avgdl")[0].as_py()

    def score(items: pa.Table) -> np.ndarray:
        words = items.column("words").combine_chunks()
        lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        found = pc.index_in(words.flatten(), value_set=vocabulary)
        known = pc.is_valid(found).to_numpy(zero_copy_only=False)
        rows = pc.list_parent_indices(words).to_numpy()[known]
        cells = rows * width + pc.drop_null(found).to_numpy()
        # Only cells that occur are weighted; the dense table is one slab of rows high.
        hit, tf = np.unique(cells, return_counts=True)
        limit = k1 * (1 - b + b * lengths[hit // width] / average)
        dense = np.zeros(len(words) * width)
        dense[hit] = tf * (k1 + 1) / (tf + limit)
        scores = dense.reshape(len(words), width) @ weights
        return np.where(scores > 0, scores, -np.inf)

    return score


def _bm25_scorer(
    k1: float, b: float, most_terms: int, most_queries: int
) -> Callable[[pa.Table], Scorer]:
    def make(queries: pa.Table) -> Scorer:
        pieces = _pieces(queries, most_terms, most_queries)
        scorers = [_piece_scorer(piece, k1, b) for piece in pieces]
        return lambda items: np.hstack([score(items) for score in scorers])

    return make


def bm25_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    item_id: str = "doc_id",
    k1: float = K1,
    b: float = B,
    idf: bool = True,
    **limits,
) -> DataFrame:
    """The k texts of highest BM25 score per query: ``query_id, <item_id>, score, rank``.

    ``queries`` carry ``query_id, text`` and the corpus ``<item_id>, text``. Whole texts are
    tokenised; a text without any query term is no hit.
    """
    weighted, words, scorer = _bm25(queries, corpus, item_id, k1, b, idf)
    return topk_join(weighted, words, scorer, k, item_id, **limits)


def _bm25(queries: DataFrame, corpus: DataFrame, item_id: str, k1: float = K1, b: float = B, idf: bool = True):
    """Weighted queries, tokenised corpus and scorer."""
    texts = spread(corpus.select(item_id, "text"), item_id)
    words = texts.select(item_id, tokens(F.col("text")).alias("words"))
    return query_weights(queries, words, idf), words, _bm25_scorer(k1, b, PIECE_TERMS, PIECE_QUERIES)


def fuse_ranks(
    left: DataFrame, right: DataFrame, k: int = TOP_K, item_id: str = "doc_id", offset: int = FUSION_OFFSET
) -> DataFrame:
    """Reciprocal-rank fusion of two ranked hit lists."""
    keys = ["query_id", item_id]
    one = left.select(*keys, F.col("rank").alias("left_rank"))
    two = right.select(*keys, F.col("rank").alias("right_rank"))

    def share(rank: str):
        return F.coalesce(1.0 / (offset + F.col(rank)), F.lit(0.0))

    fused = one.join(two, keys, "full_outer").withColumn(
        "score", F.round(share("left_rank") + share("right_rank"), 6)
    )
    return rank_hits(fused, k, item_id)


def hybrid_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    item_id: str = "doc_id",
    offset: int = FUSION_OFFSET,
    **limits,
) -> DataFrame:
    """Dense and sparse hits of the same chunks fused by their ranks in the whole lists.

    Both sides carry ``text`` and ``embedding``; rows without an embedding still match by text. An item
    beyond rank ``offset + 2 k`` in both lists has less than the k-th item of either list alone, so the
    heads of that depth hold all k results. Their ranks in the other list are then counted exactly.
    """
    depth = offset + 2 * k
    vectors = [side.select(key, "embedding").where(F.col("embedding").isNotNull()) for side, key in ((queries, "query_id"), (corpus, item_id))]
    weighted, words, scorer = _bm25(queries, corpus, item_id)
    weighted = weighted.checkpoint()
    keys = ["query_id", item_id]
    dense = topk_join(*vectors, _cosine_scorer, depth, item_id, **limits).select(*keys, "rank").checkpoint()
    sparse = topk_join(weighted, words, scorer, depth, item_id, **limits).select(*keys, "rank").checkpoint()
    found_dense = exact_ranks(*vectors, _cosine_scorer, sparse.join(dense, keys, "left_anti"), item_id, **limits)
    found_sparse = exact_ranks(weighted, words, scorer, dense.join(sparse, keys, "left_anti"), item_id, **limits)
    return fuse_ranks(dense.unionByName(found_dense), sparse.unionByName(found_sparse), k, item_id, offset)
