"""Removal of repeated word windows on a compacted De Bruijn graph.

Every window of ``length`` consecutive words is an edge, from its first ``length - 1`` words to its last. A
word goes where it is covered by an edge that also starts earlier. Edges are never dealt one by one:

1. Paths. Every edge has one anchor: the smallest hash of its ``gram``-word windows, leftmost first.
   Neighbouring edges with one anchor form a run, which is a path of the graph. Equal edges have equal
   anchors, so a path meets others only where they share its anchor, and a path whose anchor is nowhere
   else repeats nothing.
2. Compaction. Copies of a path are joined to their first coordinates. Where all runs of an anchor are
   one path, nothing branches off, and the whole path stays one record.
3. Branches. Where paths with one anchor differ (the ends of repeated passages), one copy of each is cut
   into its edges, read at its source coordinates. Edges are counted and joined back, and neighbours whose
   counts agree and whose first occurrences follow each other are compacted to one segment again.
4. Spans. Each run takes the segments of its path whose source lies elsewhere. They are verified against the
   words at their coordinates and chained along their source to long spans.

Anchors that hold more than a share of all runs go by aggregates that are combined before the shuffle and
by joins whose largest keys are broadcast; there are at most ``1 / SHARE`` of either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import BLANKS, checkpointed, join_counted, release, slices, stored
from larkspur.llm.repeats import Hashes, bytes_of, sliding_minimum

LENGTH = 20
GRAM = 5
#: One document in so many is looked at for large anchors. That decides how work is dealt, not results.
LOOK = 32
#: Share of runs, and least number of them, from which an anchor or a path counts as large.
SHARE = 1e-4
LARGE = 1_000
#: Bytes of text that a task hashes at once; a longer text is one piece of work.
SLICE = 2_000_000
#: The place of rows without an id.
NO_ID = -(1 << 63)

U = np.uint64
_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))

RUNS = "key long, anchor long, path long, start int, windows int"
EDGES = "anchor long, path long, at int, edge long, copies long, key long, start int"
RESULT = "doc_id long, n_words long, n_removed long, n_spans long, kept_text string, kept_sha256 string, spans array<struct<start:int,end:int,source_doc:long,source_start:int>>"


class Words:
    """The words of a slice of texts, joined by single spaces, with their places and hashes."""

    def __init__(self, texts: pa.Array):
        nothing, space = pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary())
        ended = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_binary()), nothing), nothing, space)
        data, limits = bytes_of(ended)
        blank = _BLANK[data]
        after = np.zeros(len(data), bool)
        after[1:] = ~blank[:-1]
        first = np.flatnonzero(~blank & ~after)
        sizes = np.flatnonzero(blank & after) - first
        self.data = np.where(blank, np.uint8(32), data)[~blank | after]
        self.end = np.cumsum(sizes + 1) - 1
        self.start = self.end - sizes
        self.bounds = np.searchsorted(first, limits)  # words of text i: bounds[i] to bounds[i + 1]
        self.hashes: Hashes | None = None

    def hashed(self) -> Hashes:
        self.hashes = self.hashes or Hashes(self.data)
        return self.hashes

    def of(self, start: np.ndarray, count: np.ndarray | int, which: int) -> np.ndarray:
        """Hashes of ``count`` words from each ``start``."""
        return self.hashed().of(self.start[start], self.end[start + count - 1], which)

    def paths(self, start: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
        return (self.of(start, windows + (length - 1), 1) + windows.astype(U)).view(np.int64)


def runs(words: Words, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor, path, first window, number of windows and text of each run of edges with one anchor."""
    count = len(words.start)
    sizes = np.diff(words.bounds)
    long = sizes >= length
    if not long.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    grams = words.of(np.arange(count - gram + 1), gram, 0)
    packed = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U)
    anchor = (sliding_minimum(packed, length - gram + 1) & U(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(len(anchor) + 1, np.int8)
    np.add.at(edge, words.bounds[:-1][long], 1)
    np.add.at(edge, words.bounds[1:][long] - length + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    turns = np.ones(len(anchor) + 1, bool)
    turns[1:-1] = (anchor[1:] != anchor[:-1]) | (edge[1:-1] != 0)
    first = np.flatnonzero(valid & turns[:-1])
    windows = np.flatnonzero(valid & turns[1:]) - first + 1
    text = np.searchsorted(words.bounds, first, side="right") - 1
    return grams[anchor[first]].view(np.int64), words.paths(first, windows, length), first, windows, text


def _runs(length: int, gram: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words = Words(batch.column(1))
            anchor, path, first, windows, text = runs(words, length, gram)
            keys = batch.column(0).to_numpy(zero_copy_only=False)[text]
            start = (first - words.bounds[text]).astype(np.int32)
            columns = [keys, anchor, path, start, windows.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "anchor", "path", "start", "windows"])
        release()

    return run


def _edges(length: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Single edges of the wanted runs, where the words at their source coordinates are still that path."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words = Words(batch.column(1))
            row, (start, windows, path, anchor, copies) = _listed(batch.column(2))
            row, start, windows, path, anchor, copies = _verified(words, row, start, windows, path, length, anchor, copies)
            at = _counting(windows)
            which = np.repeat(np.arange(len(windows)), windows)
            place = words.bounds[row[which]] + start[which] + at
            edge = words.of(place, length, 1).view(np.int64)
            keys = batch.column(0).to_numpy(zero_copy_only=False)[row[which]]
            columns = [anchor[which], path[which], at.astype(np.int32), edge, copies[which], keys, (start[which] + at).astype(np.int32)]
            names = ["anchor", "path", "at", "edge", "copies", "key", "start"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
        release()

    return run


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of ``sizes``, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _listed(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The fields of lists of structs, flat, with the row of each."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    fields = [flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(flat.type.num_fields)]
    return np.repeat(np.arange(len(sizes)), sizes), fields


def _verified(words: Words, row: np.ndarray, start: np.ndarray, windows: np.ndarray, path: np.ndarray, length: int, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs whose path lies at their coordinates; rows that share an id can hold others."""
    inside = words.bounds[row] + start + windows + length - 1 <= words.bounds[row + 1]
    kept = np.flatnonzero(inside)
    kept = kept[words.paths(words.bounds[row[kept]] + start[kept], windows[kept], length) == path[kept]] if len(kept) else kept
    return tuple(values[kept] for values in (row, start, windows, path, *more))


def _cleaned(length: int, texts: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema()
        for batch in slices(batches, "text", SLICE):
            words = Words(batch.column(1))
            row, (at, size, start, windows, path, source, source_at) = _listed(batch.column(2))
            row, start, windows, path, at, size, source, source_at = _verified(words, row, start, windows, path, length, at, size, source, source_at)
            count = len(words.start)
            first = words.bounds[row] + at
            edge = np.zeros(count + 1, np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + size + length - 1, -1)
            gone = np.cumsum(edge[:-1]) > 0
            spans = [[] for _ in range(batch.num_rows)]
            order = np.lexsort((at, row))
            columns = (a[order].tolist() for a in (row, at, at + size + length - 1, source, source_at))
            for i, a, e, s, p in zip(*columns, strict=True):
                last = spans[i][-1] if spans[i] else None
                if last and last["source_doc"] == s and a - last["start"] == p - last["source_start"] and a <= last["end"]:
                    last["end"] = max(last["end"], e)
                else:
                    spans[i].append({"start": a, "end": e, "source_doc": s, "source_start": p})
            for found in spans:
                for span in found:
                    span["source_doc"] = None if span["source_doc"] == NO_ID else span["source_doc"]
            kept, digests = [], []
            bytes_gone = np.repeat(gone, words.end - words.start + 1)
            for i in range(batch.num_rows):
                a, b = words.bounds[i], words.bounds[i + 1]
                lower, upper = (words.start[a], words.end[b - 1] + 1) if b > a else (0, 0)
                rest = words.data[lower:upper][~bytes_gone[lower:upper]].tobytes()[:-1]
                digests.append(hashlib.sha256(rest).hexdigest())
                if texts:
                    kept.append(rest.decode("utf-8", "replace"))
            sums = np.concatenate(([0], np.cumsum(gone)))
            removed = sums[words.bounds[1:]] - sums[words.bounds[:-1]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(3),
                    pa.array(np.diff(words.bounds)),
                    pa.array(removed),
                    pa.array([len(x) for x in spans], pa.int64()),
                    pa.array(kept if texts else [None] * batch.num_rows, pa.string()),
                    pa.array(digests),
                    pa.array(spans, schema.field("spans").type),
                ],
                schema=schema,
            )
        release()

    return run


def _arrow_schema() -> pa.Schema:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source_doc", pa.int64()), ("source_start", pa.int32())])
    names = ["doc_id", "n_words", "n_removed", "n_spans"]
    return pa.schema([*((n, pa.int64()) for n in names), ("kept_text", pa.string()), ("kept_sha256", pa.string()), ("spans", pa.list_(span))])


def _place(prefix: str = "") -> F.Column:
    return F.struct(F.col(f"{prefix}key").alias("key"), F.col(f"{prefix}start").alias("start"))


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Runs of edges whose anchor occurs more than once, with their path's copies and first coordinates.

    ``docs`` has columns key and text. ``total`` counts the runs of the anchor: beyond ``copies``, others
    branch off.
    """
    every = docs.select("key", "text").mapInArrow(_runs(length, gram), RUNS)
    looked = docs.where(F.pmod(F.xxhash64("key"), F.lit(LOOK)) == 0).select("key", "text").mapInArrow(_runs(length, gram), RUNS)
    seen = checkpointed(looked.groupBy("anchor").count().where(F.col("count") > 4))
    total = seen.agg(F.sum("count")).first()[0] or 0
    large = checkpointed(seen.where(F.col("count") > max(LARGE // LOOK, int(total * SHARE))).select("anchor"))

    path, anchor = Window.partitionBy("anchor", "path"), Window.partitionBy("anchor")
    small = (
        every.join(F.broadcast(large), "anchor", "left_anti")
        .repartition("anchor")
        .select("*", F.count(F.lit(1)).over(path).alias("copies"), F.min(_place()).over(path).alias("first"))
        .withColumn("total", F.count(F.lit(1)).over(anchor))
        .where("total > 1")
    )
    if large.isEmpty():
        return stored(small, "runs")
    many = stored(every.join(F.broadcast(large), "anchor", "left_semi"), "large_runs")
    paths = stored(many.groupBy("anchor", "path").agg(F.count(F.lit(1)).alias("copies"), F.min(_place()).alias("first")), "paths")
    totals = paths.groupBy("anchor").agg(F.sum("copies").alias("total"))  # a row for each large anchor
    found = join_counted(many, paths, ["anchor", "path"], "copies", SHARE, LARGE).join(F.broadcast(totals), "anchor").where("total > 1")
    return stored(small.unionByName(found), "runs")


def compacted_segments(docs: DataFrame, branching: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per anchor and path, its edges compacted to segments whose copies and sources run in parallel."""
    first = (F.col("key") == F.col("first.key")) & (F.col("start") == F.col("first.start"))
    wanted = branching.where(first).groupBy("key").agg(F.collect_set(F.struct("start", "windows", "path", "anchor", "copies")).alias("wanted"))
    edges = stored(docs.join(wanted, "key").select("key", "text", "wanted").mapInArrow(_edges(length), EDGES), "edges")
    counted = edges.groupBy("anchor", "edge").agg(
        F.sum("copies").alias("copies"), F.min(_place()).alias("source"), F.count(F.lit(1)).alias("rows")
    )
    counted = stored(counted, "counted_edges")
    joined = join_counted(edges.select("anchor", "path", "at", "edge"), counted, ["anchor", "edge"], "rows", SHARE, LARGE)
    lists = joined.groupBy("anchor", "path").agg(F.array_sort(F.collect_set(F.struct("at", "copies", "source"))).alias("edges"))

    def starts(edge: F.Column, i: F.Column) -> F.Column:
        before = F.get("edges", i - 1)
        parallel = (before.copies == edge.copies) & (before.source.key == edge.source.key) & (before.source.start + 1 == edge.source.start)
        return (i == 0) | ~parallel

    heads = lists.select("anchor", "path", F.size("edges").alias("n"), F.filter("edges", starts).alias("heads"))
    return heads.select(
        "anchor",
        "path",
        F.transform(
            "heads",
            lambda head, i: F.struct(
                head["at"].alias("at"), (F.coalesce(F.get("heads", i + 1)["at"], F.col("n")) - head["at"]).alias("size"), head["source"].alias("source")
            ),
        ).alias("segments"),
    )


def remove_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, texts: bool = True
) -> DataFrame:
    """Per row: n_words, n_removed, the words left (joined by a space), their digest, and the removed spans.

    A word goes where a window of ``length`` words covers it that also starts earlier: in a document with a
    smaller id, or before in the same one. ``spans`` holds word places (end exclusive) and where the same
    words start first; neighbouring spans overlap where their sources differ. ``texts`` False leaves out the
    words themselves.

    A NULL or empty text has no words. Rows without an id come before all others and keep their NULL. Rows
    that share an id count as one document: equal windows at the same place of such rows are both first, so
    wholly repeated rows keep what a single one keeps. An empty table gives no rows; other columns are not
    read.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be between 1 and length")
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    named = named.withColumn("key", F.coalesce("doc_id", F.lit(NO_ID)))
    repeated = repeated_runs(named, length, gram)
    elsewhere = (F.col("key") != F.col("source.key")) | (F.col("start") + F.col("at") != F.col("source.start"))
    run = ["key", "start", "windows", "path"]

    whole = repeated.where("total = copies").select(*run, F.lit(0).alias("at"), F.col("windows").alias("size"), F.col("first").alias("source"))
    branching = repeated.where("total > copies")
    segments = compacted_segments(named, branching, length)
    sized = stored(segments.join(branching.groupBy("anchor", "path").agg(F.count(F.lit(1)).alias("rows")), ["anchor", "path"]), "segments")
    cut = join_counted(branching.select("anchor", *run), sized, ["anchor", "path"], "rows", SHARE, LARGE).select(*run, F.inline("segments"))
    piece = F.struct(
        (F.col("start") + F.col("at")).alias("at"), "size", "start", "windows", "path", F.col("source.key").alias("source"), F.col("source.start").alias("source_at")
    )
    pieces = whole.unionByName(cut).where(elsewhere).groupBy("key").agg(F.collect_set(piece).alias("pieces"))
    return named.join(pieces, "key", "left").select("key", "text", "pieces", "doc_id").mapInArrow(_cleaned(length, texts), RESULT)
