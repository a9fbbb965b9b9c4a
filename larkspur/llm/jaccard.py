"""Exact Jaccard self-join of documents' word-shingle sets, down to the classes it connects.

Equal sets are one node, named by a 64-bit digest. Two steps find all links between different sets.

1. Families. Sets are cut into parts by the shingles' hashes, one part more than a linked pair can
   differ in shingles, so every linked pair has an equal part. Sizes are classes of the threshold's
   ratio; a set writes the signatures of its parts for its own class and for the next. Empty parts have
   none, as they say nothing. From its size follows how many parts differ at most, so how many of its own
   are equal in any linked set: sets with too few common signatures are taken out. A set with so few
   parts that none has to be equal also writes its first shingles, which two linked sets of that kind
   share. Of the others, those with a common signature are in one family. Unrelated sets hardly ever are.
2. Set relations within a family. Index lists over each set's rarest shingles hold their entries by size
   and position, so a probe skips blocks whose positions leave too little to reach the threshold. What
   is left is checked exactly; once a set is linked to one highly similar set, the answers of that set
   are its own, and no entry of that class is looked at again.

Families are of one size class, and large ones are cut into chunks of bounded size. First each chunk is
solved by itself; then only sets outside of a family's main class meet all chunks. Nothing is left out, no group
is held whole, and no pairs of a group are written: a cell returns a link for each class it joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import checkpointed, join_counted, release, slices, stored, stored_texts
from larkspur.llm.components import components

#: Shingles of a family's chunk, about. A chunk that meets probes holds twice as many: at 28 bytes each 140 MB of a
#: Python worker, as two share 1.2 GB with all that the JVM holds beside its heap.
CELL_SHINGLES = 2_500_000
#: Sets that a cell holds, about. This bounds a task's time, as sets take little memory beside their shingles.
CELL_SETS = 16_384
#: How often sets with too few common signatures for any link are taken out.
PRUNINGS = 2
#: Classes with more than this share of all sets, and this number, are joined by broadcasting their rows.
LARGE_SHARE = 1e-4
LARGE_CLASS = 500
#: Bytes of text that are hashed at once.
SLICE = 1_000_000
#: Bits of a shingle's hash that sets of a cell are compared by, and its bytes in a row.
BITS, BYTES = 40, 5
#: Ids up to which the choice of documents to read again is broadcast; beyond, texts are shuffled.
BROADCAST_IDS = 500_000
#: Digests a task remembers so as to write signatures of equal sets once.
REMEMBERED = 1_000_000

U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
BASE = U(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads each bit of 64 over all."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate((np.ones(1, U), np.full(size - 1, BASE | U(1), U))), dtype=U)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of each text (bytes ``data`` cut at ``bounds``), and where texts begin in them."""
    data = LOWER[data]
    word = IS_WORD[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
    starts[firsts] = word[firsts]
    at = np.flatnonzero(starts)
    edges = np.searchsorted(at, bounds)
    if not len(at):
        return np.zeros(0, U), edges
    place = np.arange(len(data)) - np.repeat(at, np.diff(np.append(at, len(data)))) if at[0] == 0 else None
    if place is None:
        place = np.arange(len(data))
        place[at[0] :] -= np.repeat(at, np.diff(np.append(at, len(data))))
    place[~word] = 0
    values = (data.astype(U) + U(1)) * _powers(1 << int(place.max(initial=0) + 1).bit_length())[place]
    values[~word] = 0
    return mix(np.add.reduceat(values, at)), edges


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``width``-word shingles.

    Words are runs without white space, A-Z in lower case. A text with fewer words is one shingle of all
    its words; one without words, or NULL, is the empty set.
    """
    texts = texts.cast(pa.large_binary())
    raw = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or raw[-1] == raw[0]:
        return [np.zeros(0, U) for _ in range(len(texts))]
    whole = np.frombuffer(data, np.uint8)[raw[0] : raw[-1]]
    words, edges = word_hashes(whole, raw - raw[0])
    rolled = words[: max(0, len(words) - width + 1)].copy()
    for k in range(1, width):
        rolled = mix(rolled * U(0xD6E8FEB86659FD93) + words[k : len(words) - width + 1 + k])
    sets = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= width:
            found = np.sort(rolled[a : b - width + 1])
            sets.append(found[np.append(True, found[1:] != found[:-1])])
        elif b > a:
            h = words[a : a + 1] + U(b - a)
            for k in range(a + 1, b):
                h = mix(h * U(0xD6E8FEB86659FD93) + words[k])
            sets.append(h)
        else:
            sets.append(np.zeros(0, U))
    return sets


class Sizes:
    """Classes of set sizes, and how far linked sets of a class differ.

    The threshold is the fraction ``part / whole``. A class holds sizes up to ``whole / part`` squared times
    its lowest, so a linked pair is of one class, or of two neighbours if the smaller set is near the end.
    """

    def __init__(self, part: int, whole: int):
        self.part, self.whole = part, whole
        self.lows = [1]

    def _further(self) -> None:
        self.lows.append(self.lows[-1] * self.whole**2 // self.part**2 + 1)

    def low(self, c: int) -> int:
        """The lowest size of class ``c``. Only classes that are asked for are listed: their sizes grow without end."""
        while len(self.lows) <= c:
            self._further()
        return self.lows[c]

    def class_of(self, n: int) -> int:
        while self.lows[-1] <= n:
            self._further()
        a, b = 0, len(self.lows)
        while b - a > 1:
            m = (a + b) // 2
            a, b = (m, b) if self.lows[m] <= n else (a, m)
        return a

    def lows_to(self, n: int) -> list[int]:
        """The lowest sizes of all classes up to that of ``n``, and of the two beyond."""
        self.low(self.class_of(n) + 2)
        return list(self.lows)

    def difference(self, c: int) -> int:
        """The most shingles in which a linked pair with its larger set in class ``c`` differs."""
        return 2 * (self.low(c + 1) - 1) * (self.whole - self.part) // (self.whole + self.part)

    def reaches(self, n: int, c: int) -> bool:
        """Whether a set of ``n`` may link with one of the larger class ``c``."""
        return n * self.whole >= self.low(c) * self.part

    def apart(self, n: int, c: int) -> int:
        """The most shingles in which a set of ``n`` differs from a linked one, the larger of both in class ``c``."""
        largest = min(n * self.whole // self.part, self.low(c + 1) - 1)
        return (n + largest) * (self.whole - self.part) // (self.whole + self.part)

    def parts(self, c: int) -> int:
        """How many parts a set of class ``c`` is cut into."""
        most = self.difference(c)
        if most < 8:
            return most + 1
        return most + 3 + (most // 10 if self.part * 10 < self.whole * 9 else 0)

    def head(self, n: int) -> int:
        """How many of a set's first shingles hold one of the first of any linked set."""
        return n - -(-n * self.part // self.whole) + 1

    def overlap(self, a: np.ndarray | int, b: np.ndarray | int):
        """The least overlap of linked sets with these sizes."""
        return -((a + b) * -self.part // (self.part + self.whole))


def signatures(shingles: np.ndarray, sizes: Sizes) -> list[tuple[int, int, np.ndarray]]:
    """Classes that the set takes part in, each with how many signatures a linked set has in common with it
    at least, and with the signatures."""
    own = sizes.class_of(len(shingles))
    found = []
    for c in (own, own + 1) if sizes.reaches(len(shingles), own + 1) else (own,):
        if sizes.difference(c) == 0:
            continue  # linked sets of this class are equal
        count = sizes.parts(c)
        where = ((shingles >> U(40)) % U(count)).astype(np.int64)
        held = np.bincount(where, minlength=count)
        sums = np.zeros(count, U)
        np.add.at(sums, where, mix(shingles + BASE))
        filled = np.flatnonzero(held)
        common = len(filled) - sizes.apart(len(shingles), c)
        values = mix(sums[filled] + filled.astype(U))
        if common < 1:  # a linked set has a common part if it has parts enough, else a common first shingle
            common = 1
            values = np.concatenate((values, mix(shingles[: sizes.head(len(shingles))] ^ BASE)))
        found.append((c, common, mix(values + U(c)).view(np.int64)))
    return found


def digest(shingles: np.ndarray) -> int:
    return int(mix(np.add.reduce(mix(shingles), dtype=U, keepdims=True) + U(len(shingles))).view(np.int64)[0])


def _described(width: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column(1), width)
            digests = pa.array([digest(s) if len(s) else None for s in sets], pa.int64())
            columns = [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), digests]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_shingles", "digest"])
        release()

    return run


def _signed(width: int, part: int, whole: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(part, whole)
        written: set[int] = set()
        for batch in slices(batches, "text", SLICE):
            keys, places, needs, parts = [], [], [], [np.zeros(0, np.int64)]
            for s in shingle_sets(batch.column(0), width):
                key = digest(s)
                if len(s) and key not in written:
                    if len(written) >= REMEMBERED:
                        written.clear()
                    written.add(key)
                    for c, common, found in signatures(s, sizes):
                        keys.append(key)
                        places.append(c)
                        needs.append(common)
                        parts.append(found)
            counts = [len(p) for p in parts[1:]]
            columns = [np.repeat(np.array(x, kind), counts) for x, kind in ((keys, np.int64), (places, np.int32), (needs, np.int32))]
            columns = [pa.array(c) for c in (*columns, np.concatenate(parts))]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "class", "need", "signature"])
        release()

    return run


def _sets(width: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column(2), width)
            # Where an id has several texts, only one of them is that node.
            same = [i for i, (s, node) in enumerate(zip(sets, batch.column(0).to_pylist(), strict=True)) if digest(s) == node]
            sets = [sets[i] for i in same]
            packed = [packed_set(s) for s in sets]
            lists = pa.array(packed, pa.binary())
            taken = batch.take(pa.array(same, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), lists], names=["node", "cells", "shingles"])
        release()

    return run


def packed_set(shingles: np.ndarray) -> bytes:
    """The first bits of the hashes, sorted; each in ``BYTES`` bytes."""
    return (shingles >> U(64 - BITS)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes()


def unpacked_set(value: bytes) -> np.ndarray:
    wide = np.zeros((len(value) // BYTES, 8), np.uint8)
    wide[:, :BYTES] = np.frombuffer(value, np.uint8).reshape(-1, BYTES)
    return wide.reshape(-1).view(U)


class Classes:
    """Union-find over places."""

    def __init__(self, count: int):
        self.up = list(range(count))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def rare_first(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value, which have ``BITS`` bits, its number among the different ones, and how often each of these is
    there; rare ones have small numbers. ``values`` are overwritten."""
    spare = 64 - BITS
    if len(values) < 1 << spare:  # a value and its place are one number, so sorting takes no room
        values <<= U(spare)
        for start in range(0, len(values), 1 << 18):
            values[start : start + (1 << 18)] |= np.arange(start, min(start + (1 << 18), len(values)), dtype=U)
        values.sort()
        place = np.empty(len(values), np.int32)
        np.bitwise_and(values, U((1 << spare) - 1), out=place, casting="unsafe")
        values >>= U(spare)
    else:
        place = np.argsort(values, kind="stable")
        values = values[place]
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    del values
    number = np.cumsum(fresh, dtype=np.int32)
    number -= 1
    del fresh
    seen = np.bincount(number).astype(np.int32)
    by_count = np.argsort(seen, kind="stable").astype(np.int32)
    rank = np.empty(len(seen), np.int32)
    rank[by_count] = np.arange(len(seen), dtype=np.int32)
    seen = seen[by_count]
    del by_count
    tokens = np.empty(len(place), np.int32)
    tokens[place] = rank[number]
    return tokens, seen


def linked_classes(sets: list[np.ndarray], sizes: Sizes, labels: list[int] | None = None) -> list[tuple[int, int]]:
    """Links (places in ``sets``) that join all sets which the threshold connects; a forest.

    ``labels``: sets with equal labels are known to be connected; links within a label are not returned.
    ``sets`` is emptied.
    """
    count = len(sets)
    classes = Classes(count)
    if labels is not None:
        first: dict[int, int] = {}
        for i, x in enumerate(labels):
            classes.up[i] = first.setdefault(x, i)
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    size = size[order]
    bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    ordered = [sets[i] for i in order]
    sets.clear()  # the caller's list: large cells need the room
    joined = [np.concatenate(ordered)]
    del ordered
    tokens, seen = rare_first(joined.pop())  # small ranks are rare in this cell
    alone = int(np.searchsorted(seen, 2))  # ranks below are in one set only
    least = -(-size * sizes.part // sizes.whole)
    prefix = size - least + 1

    # Index lists over the prefixes: entries by token, then by size, with their positions.
    mine = [tokens[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for each in mine:
        each.sort()
    heads = [m[:p] for m, p in zip(mine, prefix, strict=True)]
    head = np.concatenate(heads)
    owner = np.repeat(np.arange(count, dtype=np.int32), prefix)
    position = np.concatenate([np.arange(p, dtype=np.int32) for p in prefix])
    listed = np.flatnonzero(head >= alone)
    listed = listed[np.argsort(head[listed], kind="stable")]
    owner, position = owner[listed], position[listed]
    starts = np.searchsorted(head[listed], np.arange(alone, len(seen) + 1))
    ends = starts[:-1].copy()  # the entries of sets that have been probed

    mark = np.zeros(len(seen), bool)
    found = []
    for x in range(count):
        n, own = int(size[x]), int(order[x])
        here = np.flatnonzero(heads[x] >= alone)
        lists = heads[x][here] - alone
        full = [(int(i), int(starts[t]), int(ends[t])) for i, t in zip(here, lists, strict=True) if ends[t] > starts[t]]
        if full:
            others = np.concatenate([owner[a:b] for _, a, b in full])
            theirs = np.concatenate([position[a:b] for _, a, b in full])
            at = np.repeat([i for i, _, _ in full], [b - a for _, a, b in full])
            m = size[others]
            # Skipped: sets that are too small, and positions which leave too little before and behind.
            most = np.minimum(at, theirs) + np.minimum(n - at, m - theirs)
            kept = (m * sizes.whole >= n * sizes.part) & (most >= sizes.overlap(m, n))
            common = np.bincount(others[kept], minlength=1)
            near = np.flatnonzero(common)
            # Up to the smaller prefix end all common tokens are counted.
            rest = np.maximum(n - int(prefix[x]), least[near] - 1)
            near = near[common[near] + rest >= sizes.overlap(size[near], n)]
            near = near[np.argsort(-common[near], kind="stable")]
            if len(near):
                mark[mine[x]] = True
                for y in near.tolist():
                    root = classes.root(int(order[y]))
                    mine_root = classes.root(own)
                    # The answers of a linked set are this set's: its whole class is done.
                    if root != mine_root and int(mark[mine[y]].sum()) >= sizes.overlap(n, int(size[y])):
                        found.append((own, int(order[y])))
                        classes.up[root] = mine_root
                mark[mine[x]] = False
        ends[lists] += 1
    return found


def _solved(part: int, whole: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links of each cell, from rows sorted by cell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(part, whole)
        key, nodes, labels, sets = None, [], [], []
        out: list[tuple[int, int]] = []

        def solve() -> None:
            seen: dict[int, int] = {}
            for i, node in enumerate(nodes):
                seen.setdefault(node, i)
            at = list(seen.values())
            if len(at) > 1:
                known = [labels[i] for i in at]
                picked = [unpacked_set(sets[i]) for i in at]
                sets.clear()
                links = linked_classes(picked, sizes, known)
                out.extend((nodes[at[a]], nodes[at[b]]) for a, b in links)

        def batch_of(rows: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            cells = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            ids, known, values = batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5)
            for i, cell in enumerate(cells):
                if cell != key:
                    solve()
                    key, nodes, labels, sets = cell, [], [], []
                nodes.append(ids[i])
                labels.append(known[i])
                sets.append(values[i].as_py())
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        solve()
        yield batch_of(out)
        release()

    return run


def jaccard_classes(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    threshold: tuple[int, int] = (90, 100),
    cell_shingles: int = CELL_SHINGLES,
    cell_sets: int = CELL_SETS,
) -> DataFrame:
    """doc_id, n_shingles and component_id, a row for each row of ``docs``.

    Documents link where intersection / union of their sets of ``width``-word shingles is at least
    ``threshold`` (a fraction as two integers); the component is the smallest id that links reach. Words
    are runs without white space (space and controls 9 to 13), A-Z in lower case. A text with fewer words
    is one shingle; a text that is NULL or has no words has the empty set, links with nothing, and its
    component is its own id. Repeated rows are alike. A row without an id has the component of the rows
    with an equal set, if any has an id.
    Other columns are not read; no rows give no rows. Equal sets are found by 64-bit hashes, and the
    shingles of two sets are compared by 40 bits of theirs.
    """
    rows = _classified(docs, doc_id, text, width, threshold, cell_shingles, cell_sets)
    return rows.select("doc_id", "n_shingles", "component_id")


def _classified(docs: DataFrame, doc_id: str, text: str, width: int, threshold: tuple[int, int], cell_shingles: int, cell_sets: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, label (of the component; NULL without words) and component_id."""
    part, whole = threshold
    chosen = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    hashed = chosen.select("doc_id", "text", _text_hash("text").alias("text_hash"))
    schema = "doc_id long, text_hash long, n_shingles long, digest long"
    described = stored_texts(hashed.mapInArrow(_described(width), schema), "sets")
    kinds = described.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n"))

    # Families: a set is tied to the smallest one with the same signature.
    written = chosen.select("text").mapInArrow(_signed(width, part, whole), "digest long, class int, need int, signature long")
    node = F.xxhash64("digest", "class")
    group = Window.partitionBy("signature")
    shared = written.select(node.alias("node"), "signature", "need").withColumn("n", F.count("*").over(group)).where("n > 1").drop("n")
    shared = stored_texts(shared, "signatures")
    for _ in range(PRUNINGS):
        alive = shared.groupBy("node").agg(F.count_distinct("signature").alias("c"), F.max("need").alias("least")).where("c >= least").select("node")
        shared = stored(shared.join(alive, "node").withColumn("n", F.count("*").over(group)).where("n > 1").drop("n"), "signatures")
    smallest = F.min("node").over(group)
    families = components(shared.select(smallest.alias("a"), F.col("node").alias("b")))

    sizes = Sizes(part, whole)
    largest = kinds.agg(F.max("n")).first()[0] or 0
    lows = sizes.lows_to(largest)
    own = F.size(F.filter(F.array(*map(F.lit, lows)), lambda low: low <= F.col("n"))) - 1
    reach = F.col("n") * whole >= F.get(F.array(*map(F.lit, lows)), F.col("class") + 1) * part
    placed = kinds.withColumn("class", own).withColumn("class", F.explode(F.when(reach, F.array("class", F.col("class") + 1)).otherwise(F.array("class"))))
    member = placed.withColumn("tied", node).join(families.select(F.col("node").alias("tied"), F.col("label").alias("family")), "tied")
    member = checkpointed(member.select(F.col("digest").alias("node"), "family", "first", "n"))

    links = _links(chosen, member, width, sizes, cell_shingles, cell_sets)
    joined = components(links)

    classes = kinds.join(joined.withColumnRenamed("node", "digest"), "digest", "left").select("digest", "first", F.coalesce("label", "digest").alias("label"))
    classes = stored(classes, "classes")
    lowest = classes.groupBy("label").agg(F.min("first").alias("component_id"), F.count("*").alias("sets"))
    named = join_counted(classes, stored(lowest, "lowest"), ["label"], "sets", LARGE_SHARE, LARGE_CLASS).select("digest", "label", "component_id")
    rows = described.select("doc_id", "text_hash", "n_shingles", "digest").join(named, "digest", "left")
    return rows.select("doc_id", "text_hash", "n_shingles", "label", F.coalesce("component_id", "doc_id").alias("component_id"))


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def keep_one_of_each(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    threshold: tuple[int, int] = (80, 100),
    cell_shingles: int = CELL_SHINGLES,
    cell_sets: int = CELL_SETS,
) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: the one with the smallest id.

    Rows without words are nobody's copies and all stay. A class whose rows have no id keeps one of them;
    of rows with equal ids the one with the smallest hash of its text; of repeated rows one.
    """
    spread = stored(_classified(docs, doc_id, text, width, threshold, cell_shingles, cell_sets), "classes").where("label IS NOT NULL")
    key = F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "text_hash")
    first = spread.groupBy("label").agg(F.min(key).alias("first"))
    judged = spread.join(first, "label").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), (key == F.col("first")).alias("stays"))
    gone = judged.where("NOT stays").select("__id", "__hash").distinct()
    again = checkpointed(judged.where("stays").groupBy("__id", "__hash").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    same = F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col("__id")) & (_text_hash(text) == F.col("__hash"))
    kept = docs.join(gone, same, "left_anti")
    if again.isEmpty():
        return kept
    repeated = kept.join(again, same, "left_semi").withColumn("__hash", _text_hash(text)).dropDuplicates([doc_id, "__hash"]).drop("__hash")
    return kept.join(again, same, "left_anti").unionByName(repeated)


def _links(chosen: DataFrame, member: DataFrame, width: int, sizes: Sizes, cell_shingles: int, cell_sets: int) -> DataFrame:
    """Links that join the sets of each family (of one size class), whole families first."""
    part, whole = sizes.part, sizes.whole
    chunks = F.greatest(F.ceil(F.count("*") / cell_sets), F.ceil(F.sum("n") / cell_shingles)).cast("int")
    held = member.groupBy("family").agg(chunks.alias("chunks"))
    cells = checkpointed(member.join(held, "family").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int")))
    alone = cells.select("node", "family", "first", "chunk", F.lit(0).alias("probe"), F.col("node").alias("label"))
    first = stored_texts(_solve(chosen, alone, width, part, whole), "links")
    cut = cells.where("chunks > 1")
    if cut.isEmpty():
        return first

    # Sets outside of their family's main class meet all chunks; the main class is connected already.
    known = components(first)
    labelled = checkpointed(cut.join(known, "node", "left").withColumn("label", F.coalesce("label", "node")))
    counted = labelled.groupBy("family", "label").agg(F.count("*").alias("c"))
    main = counted.groupBy("family").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
    outside = labelled.join(main, "family").where("label <> main").drop("main")
    groups = outside.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / cell_sets), F.ceil(F.sum("n") / cell_shingles)).cast("int").alias("probes"))
    asked = outside.join(groups, "family").withColumn("probe", F.pmod(F.xxhash64(F.lit(1), "node"), "probes").cast("int"))
    columns = ["node", "family", "first", "chunk", "probe", "label"]
    probes = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*columns)
    index = labelled.join(groups, "family").withColumn("probe", F.explode(F.sequence(F.lit(0), F.col("probes") - 1))).select(*columns)
    second = _solve(chosen, index.unionByName(probes), width, part, whole)
    return stored_texts(first.unionByName(second), "links")


def _solve(chosen: DataFrame, cells: DataFrame, width: int, part: int, whole: int) -> DataFrame:
    """Links found in ``cells`` (node, family, first: a document with that set, chunk, probe, label)."""
    keys = ["family", "chunk", "probe"]
    asked = cells.groupBy("node", "first").agg(F.collect_list(F.struct(*keys, "label")).alias("cells"))
    if cells.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        asked = F.broadcast(asked)
    once = chosen.join(asked, F.col("doc_id") == F.col("first")).select("node", "cells", "text")
    place = "array<struct<family: long, chunk: int, probe: int, label: long>>"
    sets = once.mapInArrow(_sets(width), f"node long, cells {place}, shingles binary")
    rows = sets.select("node", F.explode("cells").alias("cell"), "shingles").select(*[f"cell.{k}" for k in keys], "node", "cell.label", "shingles")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_solved(part, whole), "a long, b long")
