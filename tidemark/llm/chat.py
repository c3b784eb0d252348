r"""Chat formatting by columnar byte assembly, with a loss mask that survives the round trip.

A turn becomes ``### role: text</turn>\n``. Inside roles and texts every backslash is doubled and every
control string (``###``, ``</turn>``; ``: `` in roles too) gets a backslash before its last byte, so
none of them stands in escaped content, nor can one begin there and end in the template. The reader
cuts at the marks and drops one backslash before any character.

Turns are dealt by range of (conversation, turn) and sorted, so that a conversation with a third of
all rows is spread over many tasks. A task takes the Arrow batches as they come: lengths of all five
segments of every turn, running offsets, and one scatter of each column into one preallocated buffer,
which becomes the Arrow text column without a copy. Rows of a conversation form one output row; beyond
``PART`` bytes, or where it may go on in another task, it is cut into parts between turns, and
``whole`` is false. Parts in the order of (first_turn, seq), nulls first, are the conversation.

Null roles and texts are empty; rows with a null conversation are one conversation, null turns come
first; equal turns are ordered by role and text; repeated rows are repeated turns; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import bound_batches, kept

OPEN, COLON, CLOSE = b"### ", b": ", b"</turn>\n"
CONTROL = (b"###", b"</turn>")
LOSS_ROLES = ("assistant",)
PART = 8 << 20
BLOCK = 1 << 20
SLASH = 92
FORMATTED = (
    "conv_id bigint, first_turn bigint, seq bigint, whole boolean, n_turns bigint, text string, "
    "loss array<struct<start: bigint, end: bigint>>"
)
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def escaped(data: np.ndarray, offsets: np.ndarray, controls: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The same strings, a backslash inserted before every backslash and inside every control string."""
    before = [np.flatnonzero(data == SLASH)]
    for mark in controls:
        at = np.flatnonzero(data == mark[0])
        at = at[at + len(mark) <= offsets[np.searchsorted(offsets, at, side="right")]]
        for i, byte in enumerate(mark):
            at = at[data[at + i] == byte]
        before.append(at + len(mark) - 1)
    before = np.unique(np.concatenate(before))
    if not len(before):
        return data, offsets
    return np.insert(data, before, SLASH), offsets + np.searchsorted(before, offsets, side="left")


def scatter(buffer: np.ndarray, starts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy string i to ``buffer[starts[i]:]``; the index of so many bytes is made at a time."""
    shift = starts - offsets[:-1]
    for low in range(0, len(data), BLOCK):
        high = min(low + BLOCK, len(data))
        inside = np.clip(offsets, low, high)
        buffer[np.arange(low, high) + np.repeat(shift, np.diff(inside))] = data[low:high]


def characters(buffer: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Code points between consecutive cuts of UTF-8 bytes."""
    first = np.append((buffer & 0xC0) != 0x80, False)
    counts = np.add.reduceat(first, cuts[:-1], dtype=np.int64) if len(cuts) > 1 else np.empty(0, np.int64)
    return np.where(cuts[1:] > cuts[:-1], counts, 0)


def assemble(roles: pa.Array, texts: pa.Array, heads: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(texts of conversations, start, end) with a conversation beginning at every row of ``heads``.

    ``start`` and ``end`` hold the place of every turn's content in code points of its conversation.
    """
    role_data, role_at = escaped(*bytes_of(roles), (*CONTROL, COLON))
    text_data, text_at = escaped(*bytes_of(texts), CONTROL)
    n = len(roles)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(OPEN), len(COLON), len(CLOSE)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    cuts = np.concatenate([[0], np.cumsum(lengths.ravel())])
    starts = cuts[:-1].reshape(n, 5)
    buffer = np.empty(cuts[-1], np.uint8)
    for place, mark in ((0, OPEN), (2, COLON), (4, CLOSE)):
        buffer[starts[:, place, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    scatter(buffer, starts[:, 1], role_data, role_at)
    scatter(buffer, starts[:, 3], text_data, text_at)
    points = np.concatenate([[0], np.cumsum(characters(buffer, cuts))])
    base = np.repeat(points[heads * 5], np.diff(np.append(heads, n)))
    start, end = points[3 : 5 * n : 5] - base, points[4 : 5 * n + 1 : 5] - base
    offsets = np.append(starts[heads, 0], cuts[-1]).astype(np.int32)
    return pa.StringArray.from_buffers(len(heads), pa.py_buffer(offsets), pa.py_buffer(buffer)), start, end


def heads_of(ids: pa.Array) -> np.ndarray:
    """Rows whose conversation is not that of the row before."""
    values, known = pc.fill_null(ids, 0).to_numpy(), pc.is_valid(ids).to_numpy(zero_copy_only=False)
    change = (values[1:] != values[:-1]) | (known[1:] != known[:-1])
    return np.concatenate([[0], np.flatnonzero(change) + 1])


def formatted_rows(rows: pa.Table, whole: np.ndarray, seq: int, roles: tuple[str, ...]) -> pa.RecordBatch:
    """One output row per conversation of ``rows``."""
    columns = [rows.column(i).combine_chunks() for i in range(4)]
    ids, turns, role, text = columns
    heads = heads_of(ids)
    texts, start, end = assemble(role, text, heads)
    marked = np.flatnonzero(pc.is_in(role, pa.array(roles)).to_numpy(zero_copy_only=False))
    spans = pa.StructArray.from_arrays([pa.array(start[marked]), pa.array(end[marked])], ["start", "end"])
    owner = np.searchsorted(marked, np.append(heads, len(ids))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(heads)), turns.take(pa.array(heads)),
            pa.array(np.arange(seq, seq + len(heads))), pa.array(whole),
            pa.array(np.diff(np.append(heads, len(ids)))), texts,
            pa.ListArray.from_arrays(pa.array(owner), spans),
        ],
        ["conv_id", "first_turn", "seq", "whole", "n_turns", "text", "loss"],
    )


def format_chats(
    turns: DataFrame, roles: tuple[str, ...] = LOSS_ROLES, part: int = PART, id_col: str = "conv_id",
    turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The conversations as text with the spans under the loss mask, see the module's heading."""
    bound_batches(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seq, opened = None, 0, False  # the last conversation so far; whether a part of it is out
        first = True

        def emit(rows, last_whole, end_of_task=False):
            nonlocal seq, first
            heads = heads_of(rows.column(0).combine_chunks())
            whole = np.ones(len(heads), bool)
            whole[0] = not (first or opened)
            if not last_whole:
                whole[-1] = False
            out = formatted_rows(rows, whole, seq, roles)
            seq, first = seq + len(heads), False
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            heads = heads_of(rows.column(0).combine_chunks())
            cut = int(heads[-1])
            if cut:
                yield emit(rows.slice(0, cut), True)
                opened = False
            held = rows.slice(cut)
            if held.nbytes > part:
                yield emit(held, False)
                held, opened = held.slice(0, 0), True
        if held is not None and held.num_rows:
            yield emit(held, False)

    wanted = turns.select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    dealt = wanted.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, FORMATTED)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    found = []
    for turn in text.split(CLOSE.decode())[:-1]:
        role, _, content = turn[len(OPEN) :].partition(COLON.decode())
        found.append((unescaped(role), unescaped(content)))
    return found


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose parts follow one another."""
    current, state = None, None

    def fresh():
        return {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "lost": 0, "chars": 0}

    def row(key, s):
        return (key, s["n"], s["turns"].hexdigest(), s["lost"], s["loss"].hexdigest(), s["chars"])

    def packed(rows):
        columns = zip(*rows, strict=True)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            [f.split()[0] for f in DIGESTS.split(", ")],
        )

    for batch in batches:
        done = []
        for at in range(batch.num_rows):
            key, text, loss = (batch.column(i)[at].as_py() for i in range(3))
            if state is None or key != current:
                if state is not None:
                    done.append(row(current, state))
                current, state = key, fresh()
            for role, content in turns_of(text):
                state["turns"].update(f"{role}\n{content}\n".encode())
                state["n"] += 1
            for span in loss:
                content = unescaped(text[span["start"] : span["end"]])
                state["loss"].update(content.encode())
                state["lost"] += len(content)
            state["chars"] += len(text)
        if done:
            yield packed(done)
    if state is not None:
        yield packed([row(current, state)])


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of every conversation, from the formatted text and its mask alone.

    Whole conversations are read where they lie. The parts of the others meet in one task each, which
    reads them one after the other: a digest of a sequence has no other way.
    """
    bound_batches(formatted.sparkSession)
    needed = ("conv_id", "text", "loss")
    whole = formatted.filter("whole").select(*needed).mapInArrow(_read, DIGESTS)
    parts = formatted.filter("NOT whole").repartition("conv_id")
    parts = parts.sortWithinPartitions("conv_id", "first_turn", "seq").select(*needed)
    return whole.unionByName(parts.mapInArrow(_read, DIGESTS))


def round_trip(turns: DataFrame, **options) -> DataFrame:
    """Format, write, and read back what was written."""
    return read_back(kept(format_chats(turns, **options), "chats"))
