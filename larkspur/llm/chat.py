"""Chat formatting by columnar byte assembly, with a loss mask over what assistants say.

A conversation becomes one string. Each turn is written as

    <s>[INST] role [/INST] text</s>

and a newline. Control strings inside roles and texts are escaped: in ``<s>``, ``</s>``, ``[INST]`` and
``[/INST]``, with any number of backslashes after their first character, one more backslash is put
there. So a control string in the output always is a mark, and taking one backslash away restores
the text.

Rows are dealt by conversation and sorted by turn. Each Arrow batch is then assembled without a loop
over turns: lengths of all segments give their offsets by cumulative sums, and each kind of segment is
copied into one preallocated buffer by index arrays.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, TAIL = b"<s>[INST] ", b" [/INST] ", b"</s>\n"
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?)</s>\n", re.DOTALL)
LOSS_ROLE = "assistant"
#: Bytes of text that are assembled at once, unless one conversation is larger.
BLOCK = 4_000_000

SCHEMA = "conv_id long, formatted string, n_turns long, loss_spans array<struct<start: long, end: long>>"
READ_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.fill_null(texts, ""), pattern=CONTROL, replacement=r"\1\\\2\3")


def unescape(text: str) -> str:
    return re.sub(ESCAPED, r"\1\2\3", text)


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its offsets into them."""
    values = values.cast(pa.large_string())
    _, offsets, data = values.buffers()
    bounds = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds


def _scatter(out: np.ndarray, starts: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> None:
    """Copy each string to its start in ``out``: one index array over all their bytes."""
    sizes = np.diff(bounds)
    whole = data[bounds[0] : bounds[-1]]
    out[np.arange(len(whole)) + np.repeat(starts - (bounds[:-1] - bounds[0]), sizes)] = whole


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns, where each turn begins and ends in them, and each text's start and end."""
    role_bytes, role_bounds = _bytes_of(escape(roles))
    text_bytes, text_bounds = _bytes_of(escape(texts))
    role_sizes, text_sizes = np.diff(role_bounds), np.diff(text_bounds)
    ends = np.cumsum(role_sizes + text_sizes + len(HEAD) + len(MIDDLE) + len(TAIL))
    bounds = np.concatenate((np.zeros(1, np.int64), ends)).astype(np.int64)
    out = np.empty(int(bounds[-1]), np.uint8)
    role_at = bounds[:-1] + len(HEAD)
    middle_at = role_at + role_sizes
    text_at = middle_at + len(MIDDLE)
    for mark, at in ((HEAD, bounds[:-1]), (MIDDLE, middle_at), (TAIL, text_at + text_sizes)):
        out[at[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    _scatter(out, role_at, role_bytes, role_bounds)
    _scatter(out, text_at, text_bytes, text_bounds)
    return out, bounds, text_at, text_at + text_sizes


def _conversations(part: pa.Table, loss_role: str) -> pa.RecordBatch:
    """One row per conversation of ``part``, whose rows are sorted and whose conversations are whole."""
    ids, roles, texts = (part.column(i).combine_chunks() for i in (0, 1, 2))
    out, bounds, text_from, text_to = assemble(roles, texts)
    key = pc.fill_null(ids, 0).to_numpy()
    nulls = ids.is_null().to_numpy(zero_copy_only=False)
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (nulls[1:] != nulls[:-1])
    first = np.flatnonzero(fresh)
    edges = np.append(first, len(key))
    # Places in code points: bytes that don't continue a character, counted up to each place.
    points = np.concatenate((np.zeros(1, np.int64), np.cumsum((out & 0xC0) != 0x80)))
    base = np.repeat(points[bounds[first]], np.diff(edges))
    said = pc.fill_null(pc.equal(roles, loss_role), False).to_numpy(zero_copy_only=False)
    before = np.concatenate((np.zeros(1, np.int64), np.cumsum(said)))
    spans = pa.StructArray.from_arrays([pa.array((points[at] - base)[said]) for at in (text_from, text_to)], names=["start", "end"])
    formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds[edges].astype(np.int64)), pa.py_buffer(out))
    columns = [
        ids.take(pa.array(first)),
        formatted.cast(pa.string()),
        pa.array(np.diff(edges).astype(np.int64)),
        pa.ListArray.from_arrays(pa.array(before[edges].astype(np.int32)), spans),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "formatted", "n_turns", "loss_spans"])


def _formatter(loss_role: str, block: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size < block:
                continue
            ids = batch.column(0).to_pylist()
            cut = len(ids)
            while cut and ids[cut - 1] == ids[-1]:
                cut -= 1
            if cut == 0:  # still one conversation; it may have begun in an earlier batch
                continue
            yield _conversations(pa.Table.from_batches([*waiting[:-1], batch.slice(0, cut)]), loss_role)
            waiting = [batch.slice(cut)]
            size = waiting[0].nbytes
        if sum(b.num_rows for b in waiting):
            yield _conversations(pa.Table.from_batches(waiting), loss_role)

    return run


def format_chat(
    turns: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = LOSS_ROLE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per conversation: the formatted string and the spans under the loss mask.

    Spans are code points of the formatted string, end exclusive: the escaped text of each turn of
    ``loss_role``. Rows follow their turn; ties, repeated rows and NULL turns (first) are ordered by role
    and text, so that the result does not depend on how rows were dealt. NULL roles and texts are
    empty. Rows whose ``conv_id`` is NULL are one conversation with that id. No rows give no rows; other
    columns are not read. A conversation is one output value, so it lies in one task.
    """
    names = zip((conv_id, turn, role, text), ("long", "long", "string", "string"), ("conv_id", "turn", "role", "text"), strict=True)
    chosen = turns.select(*[F.col(name).cast(kind).alias(to) for name, kind, to in names])
    ordered = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_formatter(loss_role, block), SCHEMA)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted string, as they were."""
    turns, at = [], 0
    for match in TURN.finditer(formatted):
        if match.start() != at:
            break
        turns.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, formatted, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
            turns = parse(formatted)
            said = [unescape(formatted[s["start"] : s["end"]]) for s in spans]
            whole = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
            loss = hashlib.sha256("".join(said).encode()).hexdigest()
            rows.append((conv, len(turns), whole, sum(map(len, said)), loss, len(formatted)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, parsed from formatted strings."""
    return formatted.select("conv_id", "formatted", "n_turns", "loss_spans").mapInArrow(_reader, READ_SCHEMA)
