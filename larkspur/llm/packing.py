"""Packing token sequences into fixed windows by Karmarkar-Karp multiway differencing.

Documents become token ids with an end id. Every full window of a document is a sequence of its own.
What is left of the documents is cut into pieces of at most ``PIECE`` ids and dealt to windows in
bounded groups: each piece starts as a partial partition, the two partial partitions with the largest
spread are merged with opposing imbalances until one is left, and its windows are nearly equal. Where
the fullest window exceeds the capacity, the number of windows rises and the group is dealt anew.

A group is what a task has read last, at most ``GROUP`` documents, so nothing is shuffled, a lost
executor costs one task, and a hot source or key is nothing special. The last group of each task is
smaller; it costs about half a window of padding for each input partition.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import release, slices

CAPACITY = 2048
END_ID = 1
PIECE = 256
GROUP = 512

SCHEMA = "doc_id long, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long"


def partition_lengths(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal items to ``windows`` windows by multiway differencing; the items' places by window."""
    if windows == 1:
        return [list(range(len(sizes)))]
    # A partial partition: sums of its non-empty windows, descending, and the window of each sum as
    # the end nodes of a linked list of items. The windows beyond them are empty.
    after = [-1] * len(sizes)
    heap = [(-size, i, [size], [(i, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, sums, ends = heapq.heappop(heap)
        _, _, more, more_ends = heapq.heappop(heap)
        over = len(sums) + len(more) - windows
        if over <= 0:
            sums, ends = sums + more, ends + more_ends
        else:
            # The smallest of one meet the largest of the other.
            sums, ends = list(sums), list(ends)
            place = len(sums) - over
            for j in range(over):
                a, b = place + j, over - 1 - j
                after[ends[a][1]] = more_ends[b][0]
                ends[a] = (ends[a][0], more_ends[b][1])
                sums[a] += more[b]
            sums += more[over:]
            ends += more_ends[over:]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, ends = [sums[i] for i in order], [ends[i] for i in order]
        low = sums[-1] if len(sums) == windows else 0
        if low:
            sums = [s - low for s in sums]
        count += 1
        heapq.heappush(heap, (-sums[0], count, sums, ends))
    dealt = []
    for first, _ in heap[0][3]:
        items = []
        while first >= 0:
            items.append(first)
            first = after[first]
        dealt.append(items)
    return dealt


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``, as few as differencing finds."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = partition_lengths(sizes, windows)
        worst = max(sum(sizes[i] for i in items) for items in dealt)
        if worst <= capacity:
            return dealt
        windows += max(1, windows // 200)


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_tokens(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level file; those of added tokens are their text."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    alphabet = _byte_alphabet()
    vocabulary = {i: bytes(map(alphabet.__getitem__, t)) if all(c in alphabet for c in t) else t.encode() for t, i in content["model"]["vocab"].items()}
    vocabulary |= {t["id"]: t["content"].encode() for t in content.get("added_tokens", [])}
    return [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]


@lru_cache(maxsize=4)
def encoder(path: str, special: bool = False) -> Callable[[str], list[int]]:
    """Ids of a text under a byte-level BPE file of the ``tokenizers`` library.

    Where merges are ranked by their ids, as in that vocabulary, ``tiktoken`` gives the same ids at
    six times the speed; other files, and texts that it can't take, are left to ``tokenizers``.
    Strings of special tokens in a text are ordinary text; with ``special``, they are those tokens, as
    that library reads them by itself, and texts that hold one are left to it.
    """
    from tokenizers import Tokenizer

    @lru_cache(maxsize=1)
    def library() -> Tokenizer:
        made = Tokenizer.from_file(path)
        made.encode_special_tokens = not special
        return made

    def by_library(text: str) -> list[int]:
        return library().encode(text, add_special_tokens=False).ids

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    alphabet = _byte_alphabet()
    vocabulary = {token: i for token, i in content["model"]["vocab"].items() if all(c in alphabet for c in token)}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in pairs]
    before = content.get("pre_tokenizer") or {}
    ranked = made == sorted(made) and made[:1] != [-1]
    if content.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not ranked:
        return by_library
    added = {t["content"] for t in content.get("added_tokens", [])}
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items() if token not in added}

    import public_tokenizers
    import tiktoken

    fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if special and any(token in text for token in added):
            return by_library(text)
        try:
            return fast.encode_ordinary(text)
        except (KeyboardInterrupt, SystemExit, MemoryError):
            raise
        except BaseException:  # its panics are no Exception; long runs of blanks cause them
            return by_library(text)

    return encode


def _packed(path: str, capacity: int, end_id: int, piece: int, group: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, special=True)
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        full: list[tuple] = []
        held = 0

        def dealt(parts: list[tuple]) -> Iterator[tuple]:
            nonlocal sequence
            items = [(d, at + i, ids[i : i + piece], n) for d, at, ids, n in parts for i in range(0, len(ids), piece)]
            for window in windows_of([len(x[2]) for x in items], capacity) if items else []:
                at, last = 0, None
                for i in sorted(window):
                    doc, start, ids, n = items[i]
                    if last and last[6] == i - 1 and start == last[1] + len(last[2]) and start > 0:
                        last[2] = np.concatenate((last[2], ids))
                        last[6] = i
                    else:
                        if last:
                            yield tuple(last[:6])
                        last = [doc, start, ids, n, sequence, at, i]
                    at += len(ids)
                yield tuple(last[:6])
                sequence += 1

        def out(rows: list[tuple]) -> pa.RecordBatch:
            docs, starts, ids, totals, sequences, offsets = zip(*rows, strict=True)
            sizes = np.fromiter((len(x) for x in ids), np.int64, len(ids))
            bounds = np.zeros(len(ids) + 1, np.int32)
            np.cumsum(sizes, out=bounds[1:])
            values = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids)))
            columns = [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes), values]
            columns += [pa.array(x, pa.int64()) for x in (totals, sequences, offsets)]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array(encode(text.as_py() or ""), np.int32)
                ids = np.append(ids, np.int32(end_id))
                rest = len(ids) - len(ids) % capacity
                for at in range(0, rest, capacity):
                    full.append((doc, at, ids[at : at + capacity], len(ids), sequence, 0))
                    sequence += 1
                    if len(full) >= group:
                        yield out(full)
                        full = []
                if rest < len(ids):
                    waiting.append((doc, rest, ids[rest:], len(ids)))
                    held += len(ids) - rest
                if len(waiting) >= group or held >= group * capacity:
                    yield out(list(dealt(waiting)))
                    waiting, held = [], 0
        rows = full + list(dealt(waiting))
        if rows:
            yield out(rows)
        release()

    return run


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    piece: int = PIECE,
    group: int = GROUP,
    finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str = SCHEMA,
) -> DataFrame:
    """Rows of pieces with their ids, their document, and their place in a sequence.

    ``vocabulary`` is the path of a tokenizer file on every machine. Each id of a document (its end id
    included) lies in exactly one piece; the pieces of a sequence follow each other without gaps and
    hold at most ``capacity`` ids. ``finish`` turns each Arrow batch of pieces into one of ``schema``
    where only figures of the ids are wanted.

    Ids are those of ``tokenizers`` without tokens of its own around a text: a special token's string inside
    a text is that token. A NULL or empty text is its end id alone. Repeated rows and repeated ids are packed like others, a
    NULL ``doc_id`` stays NULL, an empty table gives no rows, and other columns are not read.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    run = _packed(vocabulary, capacity, end_id, piece, group)
    if finish is None:
        return chosen.mapInArrow(run, schema)
    return chosen.mapInArrow(lambda batches: map(finish, run(batches)), schema)
