"""An inverted-file index of vectors, stored with a collection.

Directions are clustered on a sample; every vector goes to the list of its nearest centre, and lists are
partitions of the stored table. A search visits the lists of the nearest centres only. Lists are cut into bounded
pieces when they are written, so a large list is many tasks, and no task holds more than one piece.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.retrieval import TOP_K, _cosine_scorer, _matrix, cosine_topk
from larkspur.operators.topk import DIGITS, _Best, _score_all, rank_hits
from larkspur.session import shared_folder
from larkspur.sources.snapshots import Snapshot, open_snapshot, remove_old, write_snapshot

#: Vectors of the sample that centres are found on, for each centre; lists are about as many as their vectors.
SAMPLE_PER_LIST = 64
MOST_LISTS = 4096
#: Vectors of a piece of a list.
PIECE = 20_000
#: How many lists a search visits is fitted: so many that this share of the nearest neighbours of so many stored
#: vectors lies in them.
RECALL = 0.95
FITTED_VECTORS = 256


def _usable(rows: DataFrame, key: str) -> DataFrame:
    """Ids and directions; vectors that are missing, hold missing numbers or have no length are left out."""
    chosen = rows.select(F.col(key).alias("item"), F.col("embedding").cast("array<double>").alias("embedding"))
    square = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return chosen.where(F.coalesce(finite & (square > 0), F.lit(False)))


def _assigned(centres: np.ndarray, count: int):
    """Vectors with their ``count`` nearest centres."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                near = np.argsort(-(_matrix(pa.chunked_array([batch.column("embedding")])) @ centres.T), axis=1, kind="stable")[:, :count]
                lists = pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("embedding"), lists], names=["item", "embedding", "lists"])

    return run


def _fitted_probes(placed: DataFrame, count: int, centres: np.ndarray, recall: float) -> int:
    """Lists to visit so that ``recall`` of the sampled vectors' neighbours are found, by exact search for them."""
    share = math.ceil(min(1.0, FITTED_VECTORS / count) * 1_000_000)
    sample = placed.where(F.pmod(F.xxhash64("item", F.lit("fit")), F.lit(1_000_000)) < share).limit(2 * FITTED_VECTORS)
    sample = sample.select(F.col("item").alias("query_id"), "embedding").checkpoint()
    found = cosine_topk(sample, placed.select("item", "embedding"), TOP_K + 1, "item").where("item <> query_id")
    near = found.join(placed.select("item", "list"), "item").select("query_id", "list").toArrow()
    if not near.num_rows:
        return len(centres)
    asked = sample.toArrow()
    order = np.argsort(-(_matrix(asked.column("embedding")) @ centres.T), axis=1, kind="stable")
    place_of = np.argsort(order, axis=1)  # each list's place among those nearest to a vector
    row = {q: i for i, q in enumerate(asked.column("query_id").to_pylist())}
    places = [place_of[row[q], at] for q, at in zip(near.column("query_id").to_pylist(), near.column("list").to_pylist(), strict=True)]
    return int(np.quantile(places, recall, method="higher")) + 1


def build_index(
    vectors: DataFrame, path: str, item_id: str = "vec_id", lists: int | None = None, seed: int = 42, recall: float = RECALL
) -> Snapshot:
    """Store ``vectors`` (``item_id``, ``embedding``) in lists under ``path``, in place of an earlier index.

    The number of lists that searches visit is fitted to reach ``recall``.
    Centres are fitted on at most ``SAMPLE_PER_LIST`` vectors a list, chosen by a hash; all usable vectors are indexed.
    """
    spark = vectors.sparkSession
    shared_folder(spark)
    usable = _usable(vectors, item_id).checkpoint()
    count = usable.count()
    wanted = max(1, min(lists or math.isqrt(count), MOST_LISTS, count))
    share = min(1.0, wanted * SAMPLE_PER_LIST / max(1, count))
    sample = usable.where(F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(1_000_000)) < math.ceil(share * 1_000_000))
    if count:
        points = sample.select(array_to_vector("embedding").alias("features"))
        fitted = KMeans(k=wanted, seed=seed, distanceMeasure="cosine", maxIter=10).fit(points)
        centres = np.array(fitted.clusterCenters())
        centres = centres / np.sqrt((centres * centres).sum(axis=1, keepdims=True))
    else:
        centres = np.zeros((0, 0))
    schema = "item long, embedding array<double>, lists array<int>"
    placed = usable.mapInArrow(_assigned(centres, 1), schema).select("item", "embedding", F.get("lists", F.lit(0)).alias("list")).checkpoint()
    sizes = placed.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n") / PIECE)).cast("int")
    dealt = placed.join(F.broadcast(sizes), "list").withColumn("pieces", pieces)
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("item"), F.col("pieces")).cast("int")).select("list", "piece", "pieces", "item", "embedding")
    stored = dealt.repartition("list", "piece").sortWithinPartitions("list", "piece", "item")
    directory = sizes.select("list", "n", pieces.alias("pieces"))
    facts = {"item": item_id, "centres": centres.tolist(), "vectors": count, "probes": _fitted_probes(placed, count, centres, recall) if count else 0}
    made = write_snapshot(spark, path, {"lists": stored, "sizes": directory}, {"lists": "list"}, facts)
    remove_old(spark, path)
    return made


def open_index(spark: SparkSession, path: str) -> Snapshot:
    return open_snapshot(spark, path)


def probed_lists(index: Snapshot, asked: DataFrame) -> DataFrame:
    """The stored vectors of the lists that ``asked`` (query_id, embedding, list) names, and of no others."""
    lists = sorted(r["list"] for r in asked.select("list").distinct().collect())
    return index.table("lists").where(F.col("list").isin(lists))


def search(queries: DataFrame, index: Snapshot, k: int = TOP_K, probes: int | None = None) -> DataFrame:
    """The k items of highest cosine in the ``probes`` lists nearest to each query (query_id, embedding).

    ``probes`` is the fitted number unless given; with as many as there are lists, the result is exact.
    """
    item, centres = index.facts["item"], np.array(index.facts["centres"])
    schema = "query_id long, item_id long, score double"
    if not len(centres):
        return queries.sparkSession.createDataFrame([], f"query_id long, {item} long, score double, rank int")
    shared_folder(queries.sparkSession)
    count = probes or index.facts["probes"]
    nearest = _usable(queries, "query_id").mapInArrow(_assigned(centres, count), "item long, embedding array<double>, lists array<int>")
    asked = nearest.select(F.col("item").alias("query_id"), "embedding", F.explode("lists").alias("list")).checkpoint()
    sent = asked.join(F.broadcast(index.table("sizes").select("list", "pieces")), "list")
    sent = sent.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "item_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return _score_all(left, [right], _cosine_scorer, "item", lambda table: _Best(table.num_rows, k), DIGITS)

    keys = ["list", "piece"]
    partial = sent.groupBy(*keys).cogroup(probed_lists(index, asked).groupBy(*keys)).applyInArrow(meet, schema)
    ranked = rank_hits(partial, k).withColumn("score", F.round(F.col("score") / 10.0**DIGITS, DIGITS))
    return ranked.withColumnRenamed("item_id", item)
