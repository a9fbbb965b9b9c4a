"""The k best items of a corpus for every query, without forming query-item pairs as rows.

Scoring runs on Arrow batches: a whole block of queries against a batch of items, of which only the
k best per query leave the task. Few queries ride along with every task, after a check of their
number and size. More queries, or larger ones, are cut into blocks that meet blocks of the corpus;
every task then holds one block of either side, however large both sides are. Both ways are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A scorer takes a table of items and returns scores as (items x queries); -inf means no hit.
Scorer = Callable[[pa.Table], np.ndarray]

QUERY_LIMIT = 4096
QUERY_BYTES = 16 * 1024 * 1024
CORPUS_BLOCK = 20_000
SLAB_ROWS = 1024
DIGITS = 6


class _Best:
    """Running k best per query; equal scores prefer the lower item id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((k, queries), -np.inf)
        self.ids = np.full((k, queries), np.iinfo(np.int64).max, dtype=np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, scores = ids[order], scores[order].copy()
        columns = np.arange(scores.shape[1])
        found_scores, found_ids = [self.scores], [self.ids]
        for _ in range(min(self.k, len(ids))):
            top = scores.argmax(axis=0)
            found_scores.append(scores[top, columns][None, :])
            found_ids.append(ids[top][None, :])
            scores[top, columns] = -np.inf
        all_scores, all_ids = np.vstack(found_scores), np.vstack(found_ids)
        kept = np.lexsort((all_ids, -all_scores), axis=0)[: self.k]
        self.scores = np.take_along_axis(all_scores, kept, axis=0)
        self.ids = np.take_along_axis(all_ids, kept, axis=0)

    def rows(self, query_ids: np.ndarray) -> pa.Table:
        hit = np.isfinite(self.scores)
        queries = np.broadcast_to(query_ids, self.scores.shape)
        columns = [queries[hit].astype(np.int64), self.ids[hit], self.scores[hit]]
        return pa.table([pa.array(c) for c in columns], names=["query_id", "item_id", "score"])


class _Listed:
    """Scores of the items that each query lists in ``candidates``."""

    def __init__(self, queries: pa.Table):
        listed = queries.column("candidates").combine_chunks()
        owner = pc.list_parent_indices(listed).to_numpy()
        ids = listed.flatten().to_numpy()
        order = np.lexsort((owner, ids))
        self.ids, self.owner = ids[order], owner[order]
        self.scores = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        first, last = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        rows = np.repeat(np.arange(len(ids)), last - first)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(last - first) - last, last - first)
        self.scores[places] = scores[rows, self.owner[places]]

    def rows(self, query_ids: np.ndarray) -> pa.Table:
        hit = np.isfinite(self.scores)
        columns = [query_ids[self.owner[hit]].astype(np.int64), self.ids[hit], self.scores[hit]]
        return pa.table([pa.array(c) for c in columns], names=["query_id", "item_id", "score"])


class _Ahead:
    """How many items come before each query's ``candidates``, whose scores are in ``bars``."""

    def __init__(self, queries: pa.Table):
        listed, bars = (queries.column(n).combine_chunks() for n in ("candidates", "bars"))
        edges = listed.offsets.to_numpy() - listed.offsets[0].as_py()
        ids, scores = listed.flatten().to_numpy(), bars.flatten().to_numpy()
        self.each = [(ids[a:b], scores[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.counts = [np.zeros(len(i), np.int64) for i, _ in self.each]

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for query, (own, bars) in enumerate(self.each):
            found = scores[:, query][:, None]
            self.counts[query] += ((found > bars) | (found == bars) & (ids[:, None] < own)).sum(axis=0)

    def rows(self, query_ids: np.ndarray) -> pa.Table:
        owner = np.repeat(query_ids, [len(c) for c in self.counts]).astype(np.int64)
        ids = np.concatenate([np.zeros(0, np.int64), *(i for i, _ in self.each)])
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts]).astype(np.float64)
        return pa.table([pa.array(c) for c in (owner, ids, counts)], names=["query_id", "item_id", "score"])


def _score_all(queries: pa.Table, items, make_scorer, item_id: str, make_kept, digits: int) -> pa.Table:
    """Scores become whole numbers of the last digit at once: the last bits of a sum depend on how many
    items a machine scores together, and equal items must tie wherever they lie."""
    scorer = make_scorer(queries)
    kept = make_kept(queries)
    unit = 10.0**digits
    for table in items:
        for start in range(0, table.num_rows, SLAB_ROWS):
            slab = table.slice(start, SLAB_ROWS)
            kept.add(slab.column(item_id).to_numpy(), np.rint(scorer(slab) * unit))
    return kept.rows(queries.column("query_id").to_numpy())


def topk_join(
    queries: DataFrame,
    corpus: DataFrame,
    make_scorer: Callable[[pa.Table], Scorer],
    k: int = 3,
    item_id: str = "doc_id",
    digits: int = DIGITS,
    **limits,
) -> DataFrame:
    """``query_id, item_id, score, rank`` with the k best items per query.

    ``query_id`` and ``item_id`` are unique integers. Items are ranked by their scores with ``digits``
    decimals, equal ones by item id.
    """
    best = lambda table: _Best(table.num_rows, k)
    partial = score_join(queries, corpus, make_scorer, best, item_id, digits=digits, **limits)
    ranked = rank_hits(partial, k).withColumn("score", F.round(F.col("score") / 10.0**digits, digits))
    return ranked.withColumnRenamed("item_id", item_id)


def exact_ranks(
    queries: DataFrame,
    corpus: DataFrame,
    make_scorer: Callable[[pa.Table], Scorer],
    wanted: DataFrame,
    item_id: str = "doc_id",
    digits: int = DIGITS,
    **limits,
) -> DataFrame:
    """``query_id, <item_id>, rank`` of the pairs in ``wanted`` among all items; pairs that are no hit are left out.

    A pass over the corpus scores the wanted pairs, another counts the items ahead of each. Only counts
    leave a task. ``wanted`` is bounded per query.
    """
    listed = wanted.groupBy("query_id").agg(F.sort_array(F.collect_set(item_id)).alias("candidates"))
    limits["digits"] = digits
    scored = score_join(queries.join(listed, "query_id"), corpus, make_scorer, _Listed, item_id, **limits)
    entry = F.sort_array(F.collect_list(F.struct("item_id", "score")))
    bars = scored.groupBy("query_id").agg(entry.alias("e")).select("query_id", F.col("e.item_id").alias("candidates"), F.col("e.score").alias("bars"))
    ahead = score_join(queries.join(bars, "query_id"), corpus, make_scorer, _Ahead, item_id, **limits)
    return ahead.groupBy("query_id", F.col("item_id").alias(item_id)).agg((F.sum("score") + 1).cast("int").alias("rank"))


def score_join(
    queries: DataFrame,
    corpus: DataFrame,
    make_scorer: Callable[[pa.Table], Scorer],
    make_kept: Callable[[pa.Table], object],
    item_id: str = "doc_id",
    query_limit: int = QUERY_LIMIT,
    corpus_block: int = CORPUS_BLOCK,
    digits: int = DIGITS,
) -> DataFrame:
    """``query_id, item_id, score`` as kept by each task from its items' scores for all queries.

    Scores are whole numbers, in units of the last of ``digits`` decimals.

    ``make_kept`` takes the queries and returns what adds up items (``add``) and gives rows (``rows``).
    The size of the queries is measured where they are; only small ones are fetched to ride along.
    """
    schema = "query_id long, item_id long, score double"
    size = F.length(F.to_json(F.struct("*"))) if queries.columns else F.lit(0)
    counted = queries.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    if counted["n"] <= query_limit and (counted["bytes"] or 0) <= QUERY_BYTES:
        shared = queries.sparkSession.sparkContext.broadcast(queries.toArrow())

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if shared.value.num_rows == 0:
                return
            tables = (pa.Table.from_batches([b]) for b in batches)
            found = _score_all(shared.value, tables, make_scorer, item_id, make_kept, digits)
            yield from found.to_batches()

        partial = corpus.mapInArrow(scan, schema)
    else:
        query_blocks = max(1, math.ceil(counted["n"] / query_limit))
        corpus_blocks = max(1, math.ceil(corpus.count() / corpus_block))

        def spread(rows: DataFrame, key: str, own: str, blocks: int, other: str, copies: int):
            own_block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
            every_other = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
            return rows.withColumn(own, own_block).withColumn(other, every_other)

        left = spread(queries, "query_id", "__qb", query_blocks, "__cb", corpus_blocks)
        right = spread(corpus, item_id, "__cb", corpus_blocks, "__qb", query_blocks)

        def meet(query_block: pa.Table, corpus_part: pa.Table) -> pa.Table:
            if query_block.num_rows == 0:
                return pa.table(
                    {"query_id": pa.array([], pa.int64()), "item_id": pa.array([], pa.int64()),
                     "score": pa.array([], pa.float64())}
                )
            return _score_all(query_block, [corpus_part], make_scorer, item_id, make_kept, digits)

        keys = ["__qb", "__cb"]
        partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
    return partial


def rank_hits(hits: DataFrame, k: int, item: str = "item_id", query: str = "query_id") -> DataFrame:
    """Number the hits of each query by score and keep k; Spark prunes to k per task beforehand."""
    order = Window.partitionBy(query).orderBy(F.col("score").desc(), F.col(item))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
