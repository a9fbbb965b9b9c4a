"""Removal of repeated byte strings with suffix arrays.

A byte goes where it is covered by a string of ``length`` bytes that also starts anywhere else. The work
is cut so that suffix arrays are built only where a decision needs them.

1. Anchors. Every string has one anchor: the smallest hash among its ``gram``-byte windows, leftmost
   first. That depends on nothing but the string, so equal strings have equal anchors at equal offsets.
   Consecutive strings with one anchor form a run, and each string lies in exactly one run.
2. Equal runs. Runs with the same anchor and the same bytes repeat each other wholly. A run whose anchor
   is nowhere else repeats nothing.
3. Suffix arrays. What remains are runs with the same anchor and different bytes: the ends of repeated
   passages. One copy of each goes to a shard by its anchor. There, strings whose middle nobody shares are
   left out (``BLOCK`` neighbours at a time). The suffix array of the others is built by induced
   sorting: suffixes are classified as larger or smaller than the next, the leftmost smaller substrings
   are sorted, recursively where their names repeat, and all others are induced in two linear scans.
   Common prefixes with the preceding suffix, in text order, then tell which strings repeat.

Strings meet only where their anchors agree, so shards need nothing of each other. Where one anchor has
more than a shard of different runs, its strings are counted by their 128-bit hashes instead, which
spreads them over all tasks and combines equal ones before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import checkpointed, release, slices, stored
from larkspur.llm.jaccard import mix
from larkspur.llm.suffixes import common_prefixes, suffix_array

LENGTH = 200
GRAM = 50
#: Bytes of a shard, and from which on an anchor's runs are counted by hashes.
SHARD_BYTES = 1_000_000
#: Texts up to which the choice of texts to read again is broadcast; beyond, they are joined by shuffling.
BROADCAST_KEYS = 500_000
#: Texts of copies that a task remembers, so as to write the runs of equal texts once.
REMEMBERED = 1_000_000
SLICE = 1_000_000
#: One text in so many is looked at for large anchors, which decides how work is dealt, not results. Large are those
#: with more than this share of the runs, and this number.
LOOK = 32
SHARE = 1e-4
LARGE = 1_000
#: Neighbouring strings whose common middle is compared at once.
BLOCK = 16

U = np.uint64


@lru_cache(maxsize=2)
def _tables(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Random values of bytes for two hashes, and powers of the base and its inverse modulo 2**64."""
    values = np.random.RandomState(7).randint(0, 1 << 62, size=(2, 256)).astype(U) | U(1)
    base = 0x9E3779B97F4A7C15
    size = 1 << bits
    powers = np.full(size, base, U)
    powers[0] = 1
    inverse = np.full(size, pow(base, -1, 1 << 64), U)
    inverse[0] = 1
    return values[0], values[1], np.cumprod(powers, dtype=U), np.cumprod(inverse, dtype=U)


class Hashes:
    """Hashes of all substrings of ``data``, from sums over its prefixes."""

    def __init__(self, data: np.ndarray):
        first, second, powers, self.inverse = _tables(max(16, len(data).bit_length()))
        self.sums = []
        for values in (first, second):
            sums = np.zeros(len(data) + 1, U)
            np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
            self.sums.append(sums)

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        sums = self.sums[which]
        return mix((sums[end] - sums[start]) * self.inverse[start])

    def grams(self, size: int) -> np.ndarray:
        sums = self.sums[0]
        count = len(sums) - size
        return mix((sums[size:] - sums[:count]) * self.inverse[:count])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by minima from both ends of blocks."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(U).max, U)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).reshape(-1)
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[:count], before[width - 1 : width - 1 + count])


def runs(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first and last string's start, anchor's start, and text of each run.

    ``data`` are the bytes of all texts, cut at ``bounds``; starts count from the beginning of ``data``.
    """
    sizes = np.diff(bounds)
    none = np.zeros(0, np.int64)
    if len(data) < length or not (sizes >= length).any():
        return none, none, none, none, none, none
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    packed = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U)
    anchor = (sliding_minimum(packed, length - gram + 1) & U(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(len(anchor) + 1, np.int8)
    long = sizes >= length
    np.add.at(edge, bounds[:-1][long], 1)
    np.add.at(edge, np.minimum(bounds[1:][long] - length + 1, len(anchor)), -1)
    valid = np.cumsum(edge[:-1]) > 0
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    start, end = np.flatnonzero(fresh), np.flatnonzero(last)
    content = hashes.of(start, end + length, 1) + (end - start).astype(U)
    text = np.searchsorted(bounds, start, side="right") - 1
    return grams[anchor[start]].view(np.int64), content.view(np.int64), start, end, anchor[start], text


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    return whole, bounds - bounds[0]


RUNS = "key long, anchor long, content long, start int, last int, at int"
SEGMENTS = "anchor long, content long, key long, start int, wanted boolean, at int, bytes binary"
SPANS = "key long, start int, end int"


def _runs(length: int, gram: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written: set[int] = set()
        for batch in slices(batches, "text", SLICE):
            keys = batch.column(0).to_pylist()
            fresh = []
            for i, key in enumerate(keys):
                if key not in written:
                    if len(written) >= REMEMBERED:
                        written.clear()
                    written.add(key)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            data, bounds = bytes_of(batch.column(1))
            anchor, content, start, end, middle, text = runs(data, bounds, length, gram)
            if len(start):
                owner = batch.column(0).to_numpy()[text]
                at = bounds[text]
                places = [x.astype(np.int32) for x in (start - at, end - at, middle - start)]
                columns = [pa.array(c) for c in (owner, anchor, content, *places)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor", "content", "start", "last", "at"])
        release()

    return run


def _segments(length: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of the listed runs of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            data, bounds = bytes_of(batch.column(1))
            lists = batch.column(2)
            edges = lists.offsets.to_numpy()
            parts = lists.values
            counts = np.diff(edges)
            if not counts.sum():
                continue
            parts = parts.slice(int(edges[0]), int(edges[-1] - edges[0]))
            fields = {n: parts.field(n) for n in ("anchor", "content", "start", "last", "wanted", "at")}
            begin = np.repeat(bounds[:-1], counts) + fields["start"].to_numpy()
            size = fields["last"].to_numpy() - fields["start"].to_numpy() + length
            offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
            values = data[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)]
            content = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
            owner = pa.array(np.repeat(batch.column(0).to_numpy(), counts))
            columns = [fields["anchor"], fields["content"], owner, fields["start"], fields["wanted"], fields["at"], content.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "content", "key", "start", "wanted", "at", "bytes"])
        release()

    return run


def repeated_strings(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, which of its ``length``-byte strings start anywhere else in the segments."""
    sizes = np.array([len(s) for s in segments])
    starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes + 1)))[:-1]
    text = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)  # a byte that UTF-8 never has
    order = suffix_array(text.astype(np.int64) + 1)
    strings = np.maximum(sizes - length + 1, 0)
    whole = np.zeros(len(text), bool)
    whole[np.arange(strings.sum()) + np.repeat(starts - (np.cumsum(strings) - strings), strings)] = True
    long = (common_prefixes(text, order, length, whole) >= length) & whole
    behind = np.empty(len(text), np.int64)
    behind[order[1:]] = order[:-1]
    behind[order[0]] = -1
    twice = long.copy()
    twice[behind[long]] = True
    return [twice[a : a + n] for a, n in zip(starts, strings, strict=True)]


def shared_middles(segments: list[bytes], anchors: np.ndarray, at: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Segment, first and last string of the ranges whose strings may repeat one of another segment.

    Equal strings have equal anchors at equal distances. ``BLOCK`` distances at a time, the bytes that all
    strings of these distances have are compared by a hash; who shares them with nobody is left out.
    """
    sizes = np.array([len(s) for s in segments])
    bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
    hashes = Hashes(np.frombuffer(b"".join(segments), np.uint8))
    low, high = (at - (sizes - length)) // BLOCK, at // BLOCK  # blocks of distances from the anchor
    count = high - low + 1
    owner = np.repeat(np.arange(len(segments)), count)
    block = high[owner] - (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    middle = bounds[owner] + at[owner] - BLOCK * block
    names = mix(hashes.of(middle, middle + length - BLOCK + 1, 1) + mix(anchors[owner].view(U) + block.astype(U)))
    _, inverse, seen = np.unique(names, return_inverse=True, return_counts=True)
    kept = np.flatnonzero(seen[inverse.reshape(-1)] > 1)
    first = np.maximum(at[owner] - BLOCK * block - BLOCK + 1, 0)
    last = np.minimum(at[owner] - BLOCK * block, sizes[owner] - length)
    found: list[tuple[int, int, int]] = []
    for i in kept.tolist():  # by segment, then from its first string
        o, a, b = int(owner[i]), int(first[i]), int(last[i])
        if found and found[-1][0] == o and found[-1][2] + 1 == a:
            found[-1] = (o, found[-1][1], b)
        else:
            found.append((o, a, b))
    return found


def _shards(length: int, shard_bytes: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spans of repeated strings, from rows sorted by anchor: as many anchors at once as a shard holds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # anchor, content, key, start, wanted, at, bytes
        group: dict[int, tuple] = {}  # the current anchor's, by content
        anchor, size = None, 0
        out: list[tuple[int, int, int]] = []

        def solve() -> None:
            if len(held) < 2:
                return
            anchors, at = np.array([h[0] for h in held], np.int64), np.array([h[5] for h in held], np.int64)
            parts = shared_middles([h[6] for h in held], anchors, at, length)
            if not parts:
                return
            segments = [held[i][6][a : b + length] for i, a, b in parts]
            for (i, first, _), twice in zip(parts, repeated_strings(segments, length), strict=True):
                _, _, key, start, wanted, _, _ = held[i]
                if wanted and twice.any():
                    edge = np.diff(np.concatenate((np.zeros(1, np.int8), twice.astype(np.int8), np.zeros(1, np.int8))))
                    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                        out.append((key, start + first + a, start + first + b - 1 + length))

        def batch_of(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["key", "start", "end"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for row in zip(*(part.column(i).to_pylist() for i in range(7)), strict=True):
                    if row[0] != anchor:
                        if len(group) > 1:
                            held.extend(group.values())
                            size += sum(len(g[6]) for g in group.values())
                        anchor, group = row[0], {}
                        if size >= shard_bytes:
                            solve()
                            held, size = [], 0
                            if len(out) > 10_000:
                                yield batch_of(out)
                                out = []
                    group[row[1]] = row
        if len(group) > 1:
            held.extend(group.values())
        solve()
        yield batch_of(out)
        release()

    return run


def _strings(length: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Two hashes of each string of the segments, with its place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                data, bounds = bytes_of(part.column(6))
                counts = np.diff(bounds) - length + 1
                at = np.arange(counts.sum()) + np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts)
                hashes = Hashes(data)
                pair = [hashes.of(at, at + length, k).view(np.int64) for k in (0, 1)]
                start = part.column(3).to_numpy()
                place = (at - np.repeat(bounds[:-1] - start, counts)).astype(np.int32)
                columns = [*pair, np.repeat(part.column(2).to_numpy(), counts), place, np.repeat(part.column(4).to_numpy(zero_copy_only=False), counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "g", "key", "start", "wanted"])

    return run


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, end) rows; touching ones are one."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    fresh = np.append(True, spans[1:, 0] > reach[:-1])
    first = np.flatnonzero(fresh)
    return np.stack((spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]), 1)


CUT = "key long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches, "text"):
        rows = []
        for key, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            whole = text.as_buffer() if hasattr(text, "as_buffer") else text.as_py().encode()
            view = memoryview(whole)
            cuts = merged(np.array([(s["start"], s["end"]) for s in spans], np.int64))
            kept, at = hashlib.sha256(), 0
            for a, b in cuts.tolist():
                kept.update(view[at:a])
                at = b
            kept.update(view[at:])
            rows.append((key, int((cuts[:, 1] - cuts[:, 0]).sum()), len(cuts), kept.hexdigest(), [{"start": a, "end": b} for a, b in cuts.tolist()]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), kind)
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "n_removed", "n_spans", "kept_sha256", "spans"])


def remove_repeats(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans, a row for each row of ``docs``.

    Texts are UTF-8 bytes; a byte goes where it is covered by a string of ``length`` bytes that also starts
    anywhere else, in the same text or another (overlaps count). Spans are maximal runs of such bytes, in
    bytes, end exclusive; the digest is of what is left. A NULL text is empty; texts shorter than
    ``length`` keep all. A text that is there twice, also as a repeated row, goes wholly. Other columns are
    not read; no rows give no rows. Texts are told apart by 64-bit hashes, runs by two.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), value.alias("text")).withColumn("key", F.xxhash64("text"))
    at = F.coalesce("doc_id", F.lit(-1))
    slim = stored(chosen.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    classes = slim.groupBy("key").agg(F.count("*").alias("copies"), F.min(at).alias("first"), F.first("n_bytes").alias("size"))

    spans, mixed = _counted_runs(chosen.where(F.octet_length("text") >= length).select("doc_id", "key", "text"), length, gram)
    sizes = mixed.groupBy("anchor").agg(F.sum(F.col("last") - F.col("start") + length).alias("bytes"))
    hot = checkpointed(sizes.where(F.col("bytes") > shard_bytes).select("anchor"))
    any_hot = not hot.isEmpty()
    usual = mixed.join(hot, "anchor", "left_anti") if any_hot else mixed

    def from_runs(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
        listed = rows.groupBy("key").agg(F.collect_list(F.struct("anchor", "content", "start", "last", "wanted", "at")).alias("runs"))
        texts = _texts(chosen, listed.join(classes.select("key", "first"), "key"), "runs")
        return texts.mapInArrow(function, schema)

    shards = from_runs(usual, _segments(length), SEGMENTS).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_shards(length, shard_bytes), SPANS)
    spans = spans.unionByName(shards)
    if any_hot:
        cut_up = lambda batches: _strings(length)(_segments(length)(batches))  # noqa: E731  in one worker
        schema = "h long, g long, key long, start int, wanted boolean"
        strings = stored(from_runs(mixed.join(hot, "anchor", "left_semi"), cut_up, schema), "strings")
        twice = strings.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").select("h", "g")
        spans = spans.unionByName(strings.where("wanted").join(twice, ["h", "g"]).select("key", "start", (F.col("start") + length).cast("int").alias("end")))

    copied = classes.where((F.col("copies") > 1) & (F.col("size") >= length)).select("key")
    alone = classes.where(F.col("copies") == 1).select("key", "first")
    by_text = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans")).join(alone, "key")
    cut = _texts(chosen, stored(by_text, "spans"), "spans").mapInArrow(_cut, CUT)

    rows = slim.join(copied.withColumn("copied", F.lit(True)), "key", "left").join(cut, "key", "left")
    gone = F.col("copied").isNotNull()
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    nothing = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(gone, all_of_it).otherwise(F.coalesce("spans", nothing)).alias("spans"),
    )


def _counted_runs(docs: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Spans of runs whose anchor and content are there again, and one run of each content whose anchor has others.

    Anchors with more than a share of all runs, as a sample shows them, are counted by content before they are
    shuffled, and joined back without bringing one together.
    """
    names = ["key", "anchor", "content", "start", "last", "at"]
    every = docs.select("key", "text").mapInArrow(_runs(length, gram), RUNS).select(*names)
    looked = docs.where(F.pmod(F.xxhash64("doc_id", "key"), F.lit(LOOK)) == 0).select("key", "text").mapInArrow(_runs(length, gram), RUNS)
    seen = checkpointed(looked.groupBy("anchor").count().where(F.col("count") > 4))
    total = seen.agg(F.sum("count")).first()[0] or 0
    # At most 1 / SHARE anchors, which every task is told.
    large = [r["anchor"] for r in seen.where(F.col("count") > max(LARGE // LOOK, int(total * SHARE))).collect()]
    is_large = F.col("anchor").isin(large) if large else F.lit(False)

    same_anchor, same_content = Window.partitionBy("anchor"), Window.partitionBy("anchor", "content")
    small = every.where(~is_large)
    counted = small.select("*", F.count("*").over(same_content).alias("c"), F.row_number().over(same_content.orderBy("key", "start")).alias("i"))
    counted = counted.withColumn("n", F.count("*").over(same_anchor)).where("n > 1")
    counted = stored(counted.select(*names, (F.col("c") > 1).alias("equal"), ((F.col("n") > F.col("c")) & (F.col("i") == 1)).alias("mixed")), "runs")
    span = ["key", "start", (F.col("last") + length).cast("int").alias("end")]
    spans, mixed = counted.where("equal").select(*span), counted.where("mixed").select(*names, (~F.col("equal")).alias("wanted"))
    if large:
        many = stored(every.where(is_large), "large_runs")
        first = F.min(F.struct("key", "start", "last", "at")).alias("first")
        contents = stored(many.groupBy("anchor", "content").agg(F.count("*").alias("c"), first), "contents")
        totals = contents.groupBy("anchor").agg(F.sum("c").alias("n"))  # a row for each large anchor
        repeated = _again(many, contents.where("c > 1"))
        others = contents.join(F.broadcast(totals), "anchor").where("n > c")
        spans = spans.unionByName(repeated.select(*span))
        mixed = mixed.unionByName(others.select("anchor", "content", "first.*", (F.col("c") == 1).alias("wanted")))
    return spans, mixed


def _again(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """The ``rows`` whose content is in ``counted``, which has their numbers as ``c``.

    Contents with more than a share of all rows are at most ``1 / SHARE``; they are known to every task, so none
    of them is gathered in one.
    """
    total = counted.agg(F.sum("c")).first()[0] or 0
    large = F.col("c") > max(LARGE, int(total * SHARE))
    most = [r["content"] for r in counted.where(large).select("content").distinct().collect()]
    is_most = F.col("content").isin(most) if most else F.lit(False)
    rest = rows.where(~is_most).join(counted.where(~large).select("anchor", "content"), ["anchor", "content"], "left_semi")
    return rest.unionByName(rows.where(is_most))


def _texts(chosen: DataFrame, listed: DataFrame, what: str) -> DataFrame:
    """key, text and ``what`` for the texts that ``listed`` (key, first: an id with that text) names.

    Only these texts are moved: their ids go to all tasks if they are few, else texts are joined at once.
    """
    place = F.coalesce("doc_id", F.lit(-1))
    keys = listed.select("key", "first")
    if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        named = F.broadcast(keys.select(F.col("key").alias("k"), "first"))
        chosen = chosen.join(named, (F.col("key") == F.col("k")) & (place == F.col("first")), "left_semi")
    else:
        chosen = chosen.withColumn("first", place)
    own = chosen.select("key", "text", *[c for c in chosen.columns if c == "first"])
    return own.join(listed.select("key", *(["first"] if "first" in own.columns else []), what), ["key", "first"] if "first" in own.columns else "key").select("key", "text", what)
