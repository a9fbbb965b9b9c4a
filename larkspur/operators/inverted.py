"""A stored inverted index and its block-max search.

Texts are dealt to blocks by a hash of their id. For each term and block one row holds the postings (ids, counts
and lengths), and another the largest share that any text of the block can owe to the term. Both are
partitioned by a hash of the term, so a search reads only its terms' partitions.

A search first scores, for each query, the blocks that promise most. The k-th best score found there is a bar:
blocks whose shares add up to less can't hold a better text and their postings are not joined. The result is that
of ``bm25_topk``; a bar only saves work.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.functions.text import each_token, token_set, tokens
from larkspur.operators.corpus import tasks_for
from larkspur.operators.retrieval import B, K1, TOP_K
from larkspur.operators.topk import DIGITS, rank_hits
from larkspur.session import shared_folder
from larkspur.sources.snapshots import Snapshot, open_snapshot, remove_old, write_snapshot

#: Texts of a block, and postings of a term partition, on average.
BLOCK_TEXTS = 4096
PARTITION_POSTINGS = 20_000_000
#: Blocks a query scores before it knows its bar.
FIRST_BLOCKS = 2
#: Terms of a search that are pushed into the scan one by one; beyond, their partitions are.
PUSHED_TERMS = 2000
#: Queries that a block is scored for at once.
SLICE_QUERIES = 4096
#: Shares are summed as whole numbers of this size, which is exact in any order.
UNIT = 10**12


def build_index(
    corpus: DataFrame, path: str, item_id: str = "doc_id", text: str = "text", k1: float = K1, b: float = B, block_texts: int = BLOCK_TEXTS
) -> Snapshot:
    """Store the index of ``corpus`` under ``path``, in place of an earlier one.

    Ids are unique. Texts without a token are counted, as they shorten the mean length, but have no postings; NULL
    texts are no texts.
    """
    spark = corpus.sparkSession
    shared_folder(spark)
    known = corpus.select(F.col(item_id).alias("item"), F.col(text).alias("text")).where("text IS NOT NULL")
    words = tokens(F.col("text"))
    sizes = known.select(F.octet_length("text").alias("bytes"), F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("terms"))
    seen = sizes.agg(F.count(F.lit(1)).alias("texts"), *[F.sum(F.col(c).cast("long")).alias(c) for c in sizes.columns]).first()
    texts, total, postings = seen["texts"], seen["words"] or 0, seen["terms"] or 0
    blocks, parts = max(1, -(-texts // block_texts)), max(1, math.ceil(postings / PARTITION_POSTINGS))
    average = total / texts if total else 1.0
    share = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / average))
    # Texts move once, to the task of their block; it counts terms and lists postings without a further exchange.
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    dealt = known.withColumn("block", block).repartition(min(blocks, tasks_for(seen["bytes"])), "block")
    counted = dealt.select("block", "item", tokens(F.col("text")).alias("words"))
    each = counted.select("block", "item", F.size("words").alias("dl"), each_token(F.col("words")).alias("term")).where("term IS NOT NULL")
    entries = each.groupBy("block", "item", "dl", "term").agg(F.count("term").alias("tf")).withColumn("share", share)
    lists = entries.groupBy("block", "term").agg(
        F.count(F.lit(1)).alias("n"), F.max("share").alias("most"), F.array_sort(F.collect_list(F.struct("item", "tf", "dl"))).alias("postings")
    )
    # Three arrays take half the room of an array of structs.
    flat = [F.col(f"postings.{name}").alias(many) for name, many in (("item", "items"), ("tf", "tfs"), ("dl", "dls"))]
    lists = lists.select(_part(F.col("term"), parts).alias("part"), "term", "block", "n", "most", *flat)
    lists = lists.repartitionByRange("part", "term", "block").sortWithinPartitions("part", "term", "block")
    facts = {"texts": texts, "average": average, "k1": k1, "b": b, "parts": parts, "blocks": blocks, "item": item_id}
    made = write_snapshot(spark, path, {"postings": lists}, {"postings": "part"}, facts)
    remove_old(spark, path)
    return made


def open_index(spark: SparkSession, path: str) -> Snapshot:
    return open_snapshot(spark, path)


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def wanted_postings(index: Snapshot, terms: DataFrame) -> DataFrame:
    """The stored rows of ``terms`` (distinct ``term`` rows): a filter on partitions, and on terms where they are few."""
    few = [r["term"] for r in terms.limit(PUSHED_TERMS + 1).collect()]
    rows = index.table("postings")
    if len(few) <= PUSHED_TERMS:
        keys = terms.sparkSession.createDataFrame([(t,) for t in few], "term string").select(_part(F.col("term"), index.facts["parts"]).alias("part"))
        parts = sorted({r["part"] for r in keys.collect()})
        return rows.where(F.col("part").isin(parts) & F.col("term").isin(few))
    return rows.join(terms.select("term", _part(F.col("term"), index.facts["parts"]).alias("part")), ["part", "term"], "left_semi")


def _points(weight: Column, share: Column) -> Column:
    return F.round(weight * share * UNIT).cast("long")


def _of_block(facts: dict, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Scores one block's texts for the queries that ask for it."""
    k1, b, average = facts["k1"], facts["b"], facts["average"]

    def run(asked: pa.Table, lists: pa.Table) -> pa.Table:
        kinds = {"query_id": asked.schema.field("query_id").type, "item": lists.schema.field("items").type.value_type, "points": pa.int64()}
        if not asked.num_rows or not lists.num_rows:
            return pa.schema(kinds.items()).empty_table()
        columns = {name: pa.concat_arrays([part.flatten() for part in lists[name].chunks]) for name in ("items", "tfs", "dls")}
        items = pc.dictionary_encode(columns["items"], null_encoding="encode")
        place, size = items.indices.to_numpy(zero_copy_only=False), len(items.dictionary)
        tf, dl = (columns[name].to_numpy().astype(float) for name in ("tfs", "dls"))
        share = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / average))
        ends = np.cumsum(pc.list_value_length(lists["items"]).to_numpy())
        where = {term: (end - count, end) for term, end, count in zip(lists["term"].to_pylist(), ends, np.diff(ends, prepend=0), strict=True)}
        wanted: dict = {}
        for query, term, weight in zip(*(asked[name].to_pylist() for name in ("query_id", "term", "weight")), strict=True):
            if term in where:
                wanted.setdefault(query, []).append((*where[term], weight))
        queries, texts, points = [], [], []
        for query, terms in wanted.items():
            sums, held = np.zeros(size, np.int64), np.zeros(size, bool)
            for start, end, weight in terms:
                np.add.at(sums, place[start:end], np.floor(weight * share[start:end] * UNIT + 0.5).astype(np.int64))
                held[place[start:end]] = True
            found = np.flatnonzero(held)
            if len(found) > k:  # what may be rounded to the score of the k-th stays
                found = found[sums[found] >= np.partition(sums[found], -k)[-k] - UNIT // 10**DIGITS]
            queries += [query] * len(found)
            texts.append(found)
            points.append(sums[found])
        picked = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        values = [queries, items.dictionary.take(pa.array(picked)), np.concatenate(points) if points else picked]
        return pa.table([pa.array(v, kind) for v, kind in zip(values, kinds.values(), strict=True)], schema=pa.schema(kinds.items()))

    return run


def search(queries: DataFrame, index: Snapshot, k: int = TOP_K, idf: bool = True, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """The k texts of highest BM25 score for each query (query_id, text), as ``bm25_topk`` gives them."""
    facts, item = index.facts, index.facts["item"]
    shared_folder(queries.sparkSession)
    exploded = queries.select("query_id", each_token(token_set(F.col("text"))).alias("term")).where("term IS NOT NULL").distinct().checkpoint()
    rows = wanted_postings(index, exploded.select("term").distinct())
    # A row for each term and block: small next to the postings, which stay in the store.
    heads = rows.select("term", "block", "n", "most").checkpoint()
    found = heads.groupBy("term").agg(F.sum("n").alias("df"))
    rarity = F.log(1 + (facts["texts"] - F.col("df") + 0.5) / (F.col("df") + 0.5)) if idf else F.lit(1.0)
    weighted = exploded.join(found, "term").withColumn("weight", rarity).select("query_id", "term", "weight").checkpoint()
    promised = weighted.join(heads, "term").groupBy("query_id", "block").agg(F.sum(_points(F.col("weight"), F.col("most"))).alias("promise")).checkpoint()
    order = Window.partitionBy("query_id").orderBy(F.col("promise").desc(), "block")
    best = promised.withColumn("place", F.row_number().over(order)).where(F.col("place") <= first_blocks).drop("place").checkpoint()

    slices = max(1, -(-exploded.select("query_id").distinct().count() // SLICE_QUERIES))
    kinds = {f.name: f.dataType.simpleString() for f in [*exploded.schema.fields, *rows.schema.fields]}
    kinds["item"] = rows.schema["items"].dataType.elementType.simpleString()

    def scored(blocks: DataFrame) -> DataFrame:
        """The best texts of each of a query's ``blocks``: the k-th and all that may tie with it."""
        asked = blocks.select("query_id", "block").join(weighted, "query_id")
        asked = asked.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int"))
        lists = rows.select("term", "block", "items", "tfs", "dls")
        lists = lists.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        found = asked.groupBy("block", "slice").cogroup(lists.groupBy("block", "slice"))
        sums = found.applyInArrow(_of_block(facts, k), f"query_id {kinds['query_id']}, item {kinds['item']}, points long")
        return sums.select("query_id", F.col("item").alias(item), F.round(F.col("points") / UNIT, DIGITS).alias("score"))

    first = rank_hits(scored(best), k, item).checkpoint()
    bars = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("bar"))
    # Half a unit of the last digit: a text that would be rounded up to the bar still ties with it.
    reaches = F.col("bar").isNull() | (F.col("promise") / UNIT >= F.col("bar") - 10.0**-DIGITS)
    rest = promised.join(best, ["query_id", "block"], "left_anti").join(bars, "query_id", "left").where(reaches)
    return rank_hits(first.drop("rank").unionByName(scored(rest)), k, item)
