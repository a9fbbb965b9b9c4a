"""Exact top-k inner products by a Voronoi join.

Points are grouped by their nearest pivot; there are about as many pivots as the root of the number of points.
A group's summary (its pivot, its largest distance to it, its size) bounds every score with a query q: at most
q . pivot + |q| * radius. Each query first meets one block of the group whose pivot scores highest, which gives
it a k-th score to beat. It is then replicated only to the blocks of groups whose bound reaches that score, and
the results are merged.

Groups are split into blocks of about ``BLOCK`` rows by a hash of the id. How many queries ask for each block is
counted before anything is sent: a block that nobody asks for stays where it is, and one that more than
``CHUNK`` queries ask for is copied once per ``CHUNK`` of them. So a task holds one block and one chunk however
many rows share a pivot, and data move in proportion to the pairs that have to be scored. Of a vector that more
than a block of rows have, only rows that can be among the k best of any query take part.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import stored

#: Fewest pivots; more are taken as the table grows.
PIVOTS = 64
BLOCK = 4096
CHUNK = 8192
#: Query rows scored at once.
ROWS = 512
#: Numbers in one matrix of distances or bounds to the pivots.
CELLS = 1 << 21
#: Rows that leave a task at once.
SENT_ROWS = 8192

ASSIGNED = "vec_id long, v array<double>, cell int, distance double"
SENT = "vec_id long, v array<double>, vkey long, cell int, block int, least double"
TALLIED = "cell int, block int, asked long"
SCORED = "query_id long, vkey long, vec_id long, score long"

Groups = dict[int, tuple[int, float]]


def usable(vector: Column) -> Column:
    """Not NULL and free of NULL and non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def scaled(df: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    v = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return df.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the vectors of each length, and their rows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate((np.zeros(1, int), np.cumsum(sizes)))[:-1]
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, values[starts[at][:, None] + np.arange(size)]


def choose_pivots(points: DataFrame, pivots: int) -> list[list[float]]:
    """At most ``pivots`` vectors, by the smallest hashes of their values: equal vectors are one pivot."""
    key = F.xxhash64("v").alias("key")
    keys = [(r["key"],) for r in points.select(key).distinct().orderBy("key").limit(pivots).collect()]
    wanted = F.broadcast(points.sparkSession.createDataFrame(keys, "key long"))
    rows = points.select(key, "v").join(wanted, "key", "left_semi").dropDuplicates(["key"]).orderBy("key").collect()
    return [r["v"] for r in rows]


def without_needless_copies(points: DataFrame, k: int, block: int) -> DataFrame:
    """Leave out rows that no query can have among its ``k`` best because too many equal vectors precede them.

    Scores of equal vectors tie, and ties go to the smaller id. Without the query's own id, the ``k + 1`` smallest
    ids of a vector, with ``k`` rows each, hold every row that can be returned. Only vectors of more than ``block``
    rows are looked at; they are found by counting hashes, which combines before the shuffle, and most of their
    rows go before the shuffle too (a limit by group).
    """
    key = F.xxhash64("v").alias("key")
    hot = stored(points.select(key).groupBy("key").count().where(F.col("count") > block).select("key"), "hot")
    if hot.isEmpty():
        return points
    keyed = points.withColumn("key", F.xxhash64("v"))
    copies = keyed.join(hot, "key", "left_semi")
    repeat = F.row_number().over(Window.partitionBy("v", "vec_id").orderBy("vec_id"))
    place = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    fewer = copies.withColumn("repeat", repeat).where(F.col("repeat") <= k).drop("repeat")
    first = fewer.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    return keyed.join(hot, "key", "left_anti").unionByName(first).drop("key")


def centres_of(pivots: list[list[float]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Numbers and values of the pivots of each length."""
    by_size: dict[int, list[int]] = {}
    for i, p in enumerate(pivots):
        by_size.setdefault(len(p), []).append(i)
    return {n: (np.array(at, np.int32), np.array([pivots[i] for i in at], float).reshape(len(at), n)) for n, at in by_size.items()}


def pieces(at: np.ndarray, rows: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of rows whose matrix against ``width`` pivots has about ``CELLS`` numbers."""
    step = max(1, CELLS // max(1, width))
    for start in range(0, len(at), step):
        yield at[start : start + step], rows[start : start + step]


def _assign(pivots: list[list[float]]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = centres_of(pivots)
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int32)
            far = np.zeros(batch.num_rows)
            for every, values in matrices(batch.column(1)):
                size = values.shape[1]
                # Lengths without a pivot are groups of their own around zero.
                names, centres = known.get(size, (np.array([-1 - size], np.int32), np.zeros((1, size))))
                for at, rows in pieces(every, values, len(names)):
                    squares = (centres**2).sum(1) - 2 * rows @ centres.T
                    near = squares.argmin(1)
                    cells[at] = names[near]
                    far[at] = np.sqrt(((rows - centres[near]) ** 2).sum(1))
            columns = [batch.column(0), batch.column(1), pa.array(cells), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cell", "distance"])

    return run


def _meetings(pivots: list[list[float]], groups: Groups, first: bool, batches: Iterable[pa.RecordBatch]):
    """For each batch, bounded runs of (row, cell, block): the blocks that its queries have to meet.

    First, one block of the most promising cell; then, with the score to beat in ``least``, all other blocks
    that may hold one as high.
    """
    known = centres_of(pivots)
    reached: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
    for batch in batches:
        ids = batch.column(0).to_numpy()
        least = None if first else batch.column(3).to_numpy()
        for every, values in matrices(batch.column(1)):
            size = values.shape[1]
            if size not in reached:
                names, centres = known.get(size, (np.array([-1 - size], np.int32), np.zeros((1, size))))
                held = np.array([int(c) in groups for c in names], bool)
                names, centres = names[held], centres[held]
                count = np.array([groups[int(c)][0] for c in names], np.int64)
                reached[size] = names, centres, count, np.array([groups[int(c)][1] for c in names], float)
            names, centres, count, radius = reached[size]
            if not len(names):
                continue
            for at, rows in pieces(every, values, len(names)):
                dots = rows @ centres.T
                home = dots.argmax(1)
                home_block = ids[at] % count[home]
                if first:
                    yield batch, at, names[home], home_block.astype(np.int32)
                    continue
                reach = np.sqrt((rows**2).sum(1))[:, None] * radius
                bound = dots + reach + 1 + 1e-9 * (np.abs(dots) + reach)  # with room for rounding
                which, cell = np.nonzero(bound >= least[at][:, None])
                ends = np.cumsum(count[cell])
                # A cell may have any number of blocks: they are listed a bounded run at a time.
                for start in range(0, int(ends[-1]) if len(ends) else 0, CELLS):
                    place = np.arange(start, min(start + CELLS, int(ends[-1])))
                    entry = np.searchsorted(ends, place, side="right")
                    block = place - (ends[entry] - count[cell[entry]])
                    other = (cell[entry] != home[which[entry]]) | (block != home_block[which[entry]])
                    entry = entry[other]
                    yield batch, at[which[entry]], names[cell[entry]], block[other].astype(np.int32)


def _send(pivots: list[list[float]], groups: Groups, first: bool):
    """A row of the query for each block that it has to meet."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, cells, blocks in _meetings(pivots, groups, first, batches):
            for start in range(0, len(rows), SENT_ROWS):
                part = slice(start, start + SENT_ROWS)
                taken = batch.take(pa.array(rows[part]))
                bar = pa.array(np.full(taken.num_rows, -np.inf)) if first else taken.column(3)
                columns = [taken.column(0), taken.column(1), taken.column(2), pa.array(cells[part]), pa.array(blocks[part]), bar]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "vkey", "cell", "block", "least"])

    return run


def _tally(pivots: list[list[float]], groups: Groups, first: bool):
    """How many queries of a run ask for each block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, cells, blocks in _meetings(pivots, groups, first, batches):
            if len(cells):
                pairs, asked = np.unique(np.stack((cells, blocks), 1), axis=0, return_counts=True)
                columns = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(asked.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "block", "asked"])

    return run


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows."""
    largest = (np.abs(a).max(initial=0) or 1) * (np.abs(b).max(initial=0) or 1) * max(1, a.shape[1])
    if largest < 2**53:
        return (a @ b.T).astype(np.int64)
    if largest < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    return exact.astype(np.int64)  # raises OverflowError beyond a long


def _solve(k: int):
    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if data.num_rows and queries.num_rows:
            data = data.sort_by("vec_id")
            ids, rows = data.column("vec_id").to_numpy(), next(matrices(data.column("v")))[1]
            asked, wanted = queries.column("vec_id").to_numpy(), next(matrices(queries.column("v")))[1]
            vkeys = queries.column("vkey").to_numpy()
            least = queries.column("least").to_numpy()
            for at in range(0, len(asked), ROWS):
                scores = products(wanted[at : at + ROWS], rows)
                own = asked[at : at + ROWS, None] == ids
                bar = np.maximum(least[at : at + ROWS], -(2.0**63))
                if scores.shape[1] > k:
                    masked = np.where(own, np.iinfo(np.int64).min, scores)
                    bar = np.maximum(bar, np.partition(masked, -k, axis=1)[:, -k])
                query, place = np.nonzero((scores >= bar[:, None]) & ~own)
                score = scores[query, place]
                order = np.lexsort((ids[place], -score, query))
                query, place, score = query[order], place[order], score[order]
                starts = np.searchsorted(query, np.arange(len(scores)))
                best = np.arange(len(query)) - starts[query] < k
                query = at + query[best]
                found.append((asked[query], vkeys[query], ids[place[best]], score[best]))
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vkey", "vec_id", "score"), columns, strict=True)})

    return run


def top_k(
    data: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
    pivots: int | None = None,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """The ``k`` rows of ``data`` with the highest integer inner product for each row of ``queries``.

    Components are floor(scale * x). A query never meets rows of its own id. Fewer than ``k`` rows are all
    returned; ties go to the smaller id. Vectors that are NULL, or hold NULL or non-finite components,
    and rows without an id, take no part; vectors of different lengths are never paired. Repeated rows
    of ``data`` count as often as they are there, repeated rows of ``queries`` once; queries that share an id but
    not the vector are ranked each by itself. Other columns are not read. Without rows on either side there are
    none in the result. ``pivots`` is the root of the number of rows unless given.
    """
    points = scaled(data, vec_id, vector, scale)
    if pivots is None:
        pivots = max(PIVOTS, math.isqrt(points.count()))
    chosen = choose_pivots(points, pivots)
    candidates = without_needless_copies(points, k, block)
    assigned = stored(candidates.mapInArrow(_assign(chosen), ASSIGNED), "assigned")
    summary = assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()
    groups = {r["cell"]: (max(1, -(-r["n"] // block)), r["radius"]) for r in summary}
    asking = scaled(queries, vec_id, vector, scale).withColumn("vkey", F.xxhash64("v")).dropDuplicates(["vec_id", "v"])
    asked = stored(asking, "queries")

    sizes = data.sparkSession.createDataFrame([(c, n) for c, (n, _) in groups.items()], "cell int, blocks int")
    blocks = assigned.join(F.broadcast(sizes), "cell").select("cell", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), "vec_id", "v")

    def met(sources: DataFrame, first: bool) -> DataFrame:
        tallies = sources.mapInArrow(_tally(chosen, groups, first), TALLIED).groupBy("cell", "block").agg(F.sum("asked").alias("asked"))
        chunks = F.ceil(F.col("asked") / chunk).cast("int").alias("chunks")
        parts = stored(tallies.select("cell", "block", chunks), "parts")
        copies = blocks.join(parts, ["cell", "block"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
        sent = sources.mapInArrow(_send(chosen, groups, first), SENT).join(parts, ["cell", "block"])
        part = F.pmod(F.xxhash64(F.lit("chunk"), "vec_id", "vkey"), "chunks").cast("int")
        keys = ["cell", "block", "chunk"]
        dealt = sent.withColumn("chunk", part).select(*keys, "vec_id", "v", "vkey", "least")
        return copies.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(_solve(k), SCORED)

    query = ["query_id", "vkey"]
    start = stored(met(asked, True), "first")
    bars = start.groupBy(*query).agg(F.count("*").alias("n"), F.min("score").alias("score")).withColumnRenamed("query_id", "vec_id")
    least = F.when(F.col("n") >= k, F.col("score").cast("double")).otherwise(float("-inf"))
    barred = asked.join(bars, ["vec_id", "vkey"], "left").select("vec_id", "v", "vkey", F.coalesce(least, F.lit(float("-inf"))).alias("least"))
    scored = start.unionByName(met(stored(barred, "barred"), False))
    place = F.row_number().over(Window.partitionBy(*query).orderBy(F.col("score").desc(), "vec_id"))
    return scored.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
