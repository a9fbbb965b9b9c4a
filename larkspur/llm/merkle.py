"""A Merkle manifest of a dataset, with a proof for every row, by lag and lead windows.

Rows are leaves, numbered within their group. On each level, lag and lead columns of fixed offsets, masked by
a node's slot in its run and by the run's length, hold its siblings; the row of the first child hashes the
parent. Levels follow until each group has one node left, its subroot; subroots are numbered by group and
climb in the same way to the root. Proofs come down again: a node's proof is its siblings and its parent's.

No window holds a whole group: numbers come from ranges of rows whose sizes are added up first, and
siblings are found within blocks of ``FANOUT ** 2`` neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import stored

FANOUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values in order, each as ``-`` if NULL, else its bytes' number, a colon, and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(rows: DataFrame, by: Sequence[str], order: Sequence[str], position: str = "position", size: str = "size") -> DataFrame:
    """Add each row's place by ``order`` among the rows with its values of ``by``, and their number.

    ``rows`` must be stored. Rows that agree in ``by`` and ``order`` get any of their places.
    """
    spread = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*by, *order, "__row")
    placed = stored(spread.withColumn("__range", F.spark_partition_id()), "ranges")
    keys = [*by, "__range"]
    counts = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    # A row per range and group reaches these windows.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"), F.sum("__rows").over(group).alias(size))
    inside = Window.partitionBy(*keys).orderBy(*order, "__row")
    local = placed.withColumn("__place", F.row_number().over(inside))
    found = local.join(offsets, keys).withColumn(position, F.col("__before") + F.col("__place") - 1)
    return found.drop("__row", "__range", "__before", "__place")


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Add the digests of the siblings before and after each node of (grp, position, size, digest)."""
    slot = F.col("position") % fanout
    run = F.least(F.lit(fanout), F.col("size") - (F.col("position") - slot))
    block = F.floor(F.col("position") / fanout**2)
    order = Window.partitionBy("grp", block).orderBy("position")

    def masked(inside: Column, sibling: Column) -> Column:
        return F.when(inside, sibling)

    before = [masked(slot >= k, F.lag("digest", k).over(order)) for k in range(fanout - 1, 0, -1)]
    after = [masked(slot + k < run, F.lead("digest", k).over(order)) for k in range(1, fanout)]
    # concat_ws leaves NULLs out.
    return nodes.select("*", F.concat_ws("", *before).alias("before"), F.concat_ws("", *after).alias("after"))


def climb(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The stored levels above ``leaves`` (grp, position, size, digest and more), which come first."""
    levels = [stored(with_siblings(leaves, fanout), "level")]
    widest = levels[0].agg(F.max("size")).first()[0] or 0
    while widest > 1:
        first = levels[-1].where((F.col("size") > 1) & (F.col("position") % fanout == 0))
        parents = first.select(
            "grp",
            F.floor(F.col("position") / fanout).alias("position"),
            F.ceil(F.col("size") / fanout).alias("size"),
            F.sha2(F.concat("digest", "after"), 256).alias("digest"),
        )
        levels.append(stored(with_siblings(parents, fanout), "level"))
        widest = -(-widest // fanout)
    return levels


def tops(levels: Sequence[DataFrame]) -> DataFrame:
    """The last node of each group."""
    return reduce(DataFrame.unionByName, [level.where("size = 1").select("grp", "digest") for level in levels])


def descend(levels: Sequence[DataFrame], top: DataFrame, fanout: int) -> DataFrame:
    """The first level's rows with ``path``, their siblings up to the end of ``top``'s paths.

    ``top`` has a row for each group with the path from its last node on; its other columns come along.
    """
    carried = [c for c in top.columns if c not in ("grp", "path")]
    above = None
    for level in reversed(levels):
        own = [c for c in level.columns if c not in ("size", "before", "after")]
        rows = level.where("size = 1").join(top, "grp").select(*own, *carried, "path")
        if above is not None:
            parents = above.select("grp", F.col("position").alias("up"), *carried, F.col("path").alias("beyond"))
            step = F.array(F.struct("before", "after"))
            inner = level.where("size > 1").withColumn("up", F.floor(F.col("position") / fanout)).join(parents, ["grp", "up"])
            rows = rows.unionByName(inner.select(*own, *carried, F.concat(step, "beyond").alias("path")))
        above = rows
    return above


def manifest(docs: DataFrame, *, columns: Sequence[str] = COLUMNS, key: str = "doc_id", group: str = "lang", text: str = "text", fanout: int = FANOUT) -> DataFrame:
    """Per row: leaf, subroot, root and proof, and the root that a check of the row finds.

    A leaf is the digest of ``columns``. Rows of a ``group`` value ascend by ``key``; every ``fanout``
    neighbours become the digest of their digests, as hex text, until one is left. These subroots climb
    likewise, ordered by the group's value. ``proof`` lists the siblings before and after on each level.
    ``folded_root`` starts from the row as presented: where 3 divides the CRC-32 of the key, that has its
    text's A-Z in lower case; ``verified`` tells whether it arrives at the root.

    NULL is a group of its own and comes first; NULL keys come first in their group and are presented
    unchanged. Rows that share a key are ordered by their leaf, so wholly repeated rows are interchangeable:
    each gets one of their places. Empty texts have zero bytes. An empty table gives no rows; other columns
    are not read.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    values = {c: F.col(c) for c in columns}
    touched = values | {text: F.translate(text, upper, upper.lower())}
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.col(key).cast("long").alias("doc_id"),
        leaf_digest(*values.values()).alias("digest"),
        F.when(chosen, leaf_digest(*touched.values())).alias("tampered"),
    )
    levels = climb(numbered(stored(leaves, "leaves"), ["grp"], ["doc_id", "digest"]), fanout)
    subroots = stored(tops(levels), "subroots")
    above = climb(numbered(subroots, [], ["grp"]).select(F.lit("").alias("grp"), "position", "size", "digest", F.col("grp").alias("of")), fanout)
    root = tops(above).first()
    ended = tops(above).select("grp", F.expr("CAST(array() AS array<struct<before:string,after:string>>)").alias("path"))
    top = descend(above, ended, fanout).select(F.col("of").alias("grp"), F.col("digest").alias("subroot"), "path")
    found = descend(levels, stored(top, "top"), fanout)
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "")
    folded = F.aggregate("path", F.coalesce("tampered", "digest"), lambda at, p: F.sha2(F.concat(p["before"], at, p["after"]), 256))
    named = found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        F.col("path").alias("proof"),
    )
    return named.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(table: str = "documents", fanout: int = FANOUT, levels: int = 9, group_levels: int = 4) -> str:
    """DuckDB SQL for the digest columns of ``manifest``, for up to ``fanout ** levels`` rows."""

    def digest(text: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in COLUMNS[:-1]]
        return f"sha256({' || '.join(parts)} || coalesce(strlen({text}) || ':' || {text}, '-'))"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * strlen(d)), lambda i: i::BIGINT)), lambda c, i: "
        "CASE WHEN (xor(c, CASE WHEN i % 8 = 0 THEN ascii(d[(i // 8 + 1)::INTEGER])::BIGINT ELSE 0 END) & 1) = 1 "
        "THEN xor(xor(c, CASE WHEN i % 8 = 0 THEN ascii(d[(i // 8 + 1)::INTEGER])::BIGINT ELSE 0 END) >> 1, 3988292384::BIGINT) "
        "ELSE xor(c, CASE WHEN i % 8 = 0 THEN ascii(d[(i // 8 + 1)::INTEGER])::BIGINT ELSE 0 END) >> 1 END), 4294967295::BIGINT)"
    )
    steps = []

    def rise(name: str, start: str, count: int) -> None:
        """Runs and nodes of each level; a lone node stays as it is."""
        steps.append(f"{name}0 AS MATERIALIZED ({start})")
        for k in range(count):
            steps.append(
                f"{name}_runs{k} AS MATERIALIZED (SELECT g, pos // {fanout} AS pos, max(n) AS n, list(digest ORDER BY pos) AS kids FROM {name}{k} GROUP BY ALL)"
            )
            steps.append(
                f"{name}{k + 1} AS MATERIALIZED (SELECT g, pos, (n + {fanout - 1}) // {fanout} AS n, "
                f"CASE WHEN n > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS digest FROM {name}_runs{k})"
            )

    def walk(name: str, rows: str, levels: int, at: str) -> str:
        """Add the siblings of each level to ``proof`` and fold ``acc``."""
        for k in range(levels):
            steps.append(
                f"{name}_walk{k} AS MATERIALIZED (SELECT w.* EXCLUDE (acc, proof, {at}), w.{at} // {fanout} AS {at}, "
                f"CASE WHEN r.n > 1 THEN proof || array_to_string(kids[:w.{at} % {fanout}], '') || array_to_string(kids[w.{at} % {fanout} + 2:], '') ELSE proof END AS proof, "
                f"CASE WHEN r.n > 1 THEN sha256(array_to_string(kids[:w.{at} % {fanout}], '') || acc || array_to_string(kids[w.{at} % {fanout} + 2:], '')) ELSE acc END AS acc "
                f"FROM {rows} w JOIN {name}_runs{k} r ON r.g = w.{name}_g AND r.pos = w.{at} // {fanout})"
            )
            rows = f"{name}_walk{k}"
        return rows

    steps.append(
        f"leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY low_g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS low_pos, "
        f"count(*) OVER (PARTITION BY low_g) AS n FROM (SELECT doc_id, CAST(doc_id AS VARCHAR) AS d, coalesce('=' || lang, '') AS low_g, "
        f"{digest('text')} AS leaf, {digest(f'''translate(text, '{upper}', '{upper.lower()}')''')} AS touched FROM {table}))"
    )
    rise("low", "SELECT low_g AS g, low_pos AS pos, n, leaf AS digest FROM leaves", levels)
    rise(
        "high",
        f"SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, digest FROM low{levels}",
        group_levels,
    )
    steps.append(f"subroots AS MATERIALIZED (SELECT g, digest, row_number() OVER (ORDER BY g) - 1 AS high_pos FROM low{levels})")
    steps.append(
        f"begun AS MATERIALIZED (SELECT l.doc_id, leaf, low_g, low_pos, '' AS high_g, high_pos, s.digest AS subroot, '' AS proof, "
        f"CASE WHEN {crc} % 3 = 0 THEN touched ELSE leaf END AS acc FROM leaves l JOIN subroots s ON s.g = l.low_g)"
    )
    last = walk("high", walk("low", "begun", levels, "low_pos"), group_levels, "high_pos")
    return (
        f"WITH {', '.join(steps)} SELECT w.doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, "
        f"acc AS folded_root, acc = r.digest AS verified FROM {last} w CROSS JOIN high{group_levels} r"
    )
