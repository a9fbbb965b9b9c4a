"""Mixing sources to target weights by Poisson replication.

A source's rate is how often its documents have to be repeated, on average, to reach its share of the
output. Each document draws its number of copies from the Poisson distribution with that mean, by
inverting the distribution at a number in (0, 1) that a hash of its id decides: the same input gives
the same output on every run and machine. Copies are rows of their own, and all rows are shuffled
globally by a hash.

Everything is a DataFrame expression. A hot source is only a number in the rates; its rows are never
brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import checkpointed, unit_hash

SEED = 42
#: Largest mean that is inverted at once, and copies of a row that one task explodes.
PART_RATE = 256.0
COPY_BLOCK = 1024
#: Sources up to which the rates are broadcast (under 10 MB); beyond, they are joined by shuffling.
BROADCAST_SOURCES = 20_000


def source_rates(docs: DataFrame, weights: dict[str, float] | None, total: int | None, *, source: str = "source") -> DataFrame:
    """Mean repetitions by source: weight / sum of weights * total / documents of the source.

    ``weights`` of None weigh all sources alike, NULL being a source; else sources without a weight
    get the rate 0. ``total`` is the expected number of output rows, by default that of ``docs``.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.lit(1.0)
    elif any(not w >= 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    else:
        given = [F.lit(x) for name, w in weights.items() for x in (name, float(w))]
        weight = F.coalesce(F.try_element_at(F.create_map(*given), F.col("source")), F.lit(0.0)) if given else F.lit(0.0)
    weighted = checkpointed(counts.withColumn("weight", weight))
    sums = weighted.agg(F.sum("weight").alias("weights"), F.sum("n").alias("rows")).first()
    if not sums["weights"]:
        return weighted.select("source", F.lit(0.0).alias("rate"))
    rows = sums["rows"] if total is None else total
    return weighted.select("source", (F.col("weight") / F.lit(float(sums["weights"])) * F.lit(float(rows)) / F.col("n")).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """The cumulative Poisson probabilities of 0, 1, 2, ..., as far as a double tells them from 1."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log_p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def add(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.log(rate) - F.log(k.cast("double"))
        total = state["sum"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("sum"), F.concat(state["steps"], F.array(total)).alias("steps"))

    steps = F.aggregate(F.sequence(F.lit(1), last), start, add, lambda s: s["steps"])
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(1.0)))


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    *,
    total: int | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    copy: str = "copy",
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with each row repeated by its Poisson draw, in a global random order.

    ``copy`` (a new column, numbered from 1) tells copies of a row apart; a column of that name in
    ``docs`` raises ValueError. All columns are kept. Rows with equal ids draw equal counts, and so do
    all rows without an id. An empty table, or weights that are all 0, give no rows.
    """
    if copy in docs.columns:
        raise ValueError(f"docs has a column {copy}")
    rate = F.col("rate")
    parts = F.greatest(F.lit(1), F.ceil(rate / PART_RATE)).cast("int")
    steps = poisson_steps(rate / parts)
    rates = source_rates(docs, weights, total, source=source).select(F.col("source").alias("__source"), parts.alias("__parts"), steps.alias("__steps"))
    rates = checkpointed(rates)
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    drawn = docs.join(rates, F.col(source).eqNullSafe(F.col("__source")), "left")

    def below(u: Column) -> Column:
        return F.aggregate("__steps", F.lit(0), lambda n, s: n + (s <= u).cast("int"))

    # The first part's number is in a column of its own: it is all there is but for large rates.
    more = F.transform(F.sequence(F.lit(2), "__parts"), lambda part: below(unit_hash(doc_id, part, seed=seed)))
    rest = F.when(F.col("__parts") > 1, F.aggregate(more, F.lit(0), lambda n, k: n + k)).otherwise(0)
    counted = drawn.withColumn("__u", unit_hash(doc_id, seed=seed)).withColumn("__n", below(F.col("__u")) + rest).where(F.col("__n") > 0)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    few = counted.where(F.col("__n") <= COPY_BLOCK).select(*columns, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias(copy))
    rows = few
    if rates.where("__parts > 1").limit(1).count():
        # Rows with many copies are dealt out block by block, so that none is exploded in one task.
        blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / COPY_BLOCK).cast("int"))).alias("__block")
        many = counted.where(F.col("__n") > COPY_BLOCK).select(*columns, "__n", blocks)
        dealt = many.repartition(F.xxhash64(F.col(doc_id), F.col("__block")))
        first = F.col("__block") * COPY_BLOCK + 1
        rows = few.unionByName(dealt.select(*columns, F.explode(F.sequence(first, F.least(first + COPY_BLOCK - 1, F.col("__n")))).alias(copy)))
    place = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(copy))
    return rows.withColumn("__place", place).repartition("__place").sortWithinPartitions("__place").drop("__place")
