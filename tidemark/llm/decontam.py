"""Benchmark decontamination: one Aho-Corasick automaton over the normalised items.

Items and documents become words (A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``). Every
window of ten consecutive item words is one pattern, an item of fewer words is one pattern whole.
The automaton reports every place of every pattern in one scan of the normalised text; places become
word numbers, and for texts that have any, spans in the original characters.

The patterns are the stated query set. They are read in blocks of a bounded number of characters
(``block_chars``): one block, the usual case, is one pass; more are further passes over the texts,
each with its own automaton, so what a task holds is bounded however long the benchmark is.

Null and empty texts have no words; items without words have no pattern; items with the same id are
one item; equal items are each reported; items without an id are one item too, whose hits count and
whose place in ``items`` is a null at the end that the digest of the ids leaves out; repeated documents are scanned each for itself.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import WORD_BYTES, WORD_OF_TEXT, bound_batches, kept, rows_of, texts_of

WINDOW = 10
BLOCK_CHARS = 32_000_000

FOUND = "n_words bigint, hits array<struct<first: bigint, last: bigint>>, items array<bigint>"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def patterns_of(text: str, window: int = WINDOW) -> set[str]:
    """The windows of an item, each with a space at either end so that it stands on whole words."""
    words = words_of(text)
    if not words:
        return set()
    last = max(1, len(words) - window + 1)
    return {f" {b' '.join(words[i : i + window]).decode()} " for i in range(last)}


def pattern_blocks(items: DataFrame, window: int, block_chars: int) -> Iterator[dict[str, list[int]]]:
    """Pattern -> item ids, in blocks of about ``block_chars`` characters of patterns."""
    block: dict[str, list[int]] = defaultdict(list)
    size = 0
    rows = items.orderBy("doc_id", "text").toLocalIterator()
    for item_id, text in rows:
        for pattern in patterns_of(text, window):
            size += 0 if pattern in block else len(pattern)
            block[pattern].append(item_id)
        if size >= block_chars:
            yield dict(block)
            block, size = defaultdict(list), 0
    yield dict(block)


def in_order(ids) -> list[int | None]:
    """Distinct item ids, the missing one last."""
    return sorted(set(ids), key=lambda i: (i is None, i or 0))


def automaton_of(block: dict[str, list[int]]):
    machine = ahocorasick.Automaton()
    for pattern, ids in block.items():
        machine.add_word(pattern, (pattern.count(" ") - 1, in_order(ids)))
    machine.make_automaton()
    return machine


def scan(text: str, machine) -> tuple[int, list[tuple[int, int]], list[int]]:
    """Number of words, merged runs (first, last) of hit words, ids of the items found."""
    words = words_of(text)
    if not len(machine) or not words:
        return len(words), [], []
    line = f" {b' '.join(words).decode()} "
    places, items = [], set()
    for end, (length, ids) in machine.iter(line):
        places.append((end, length))
        items.update(ids)
    if not places:
        return len(words), [], []
    # The blank before word i is blank i, so a pattern ends at the blank after its last word.
    blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)
    ends = np.searchsorted(blanks, [end for end, _ in places]) - 1
    starts = ends - np.array([length for _, length in places]) + 1
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends + 1, -1)
    hit = np.concatenate(([0], np.cumsum(marks)[:-1] > 0, [0])).astype(np.int8)
    turns = np.diff(hit)
    firsts, lasts = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1) - 1
    return len(words), list(zip(firsts.tolist(), lasts.tolist(), strict=True)), in_order(items)


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point spans of the original text, end exclusive, for runs of words."""
    if not runs:
        return []
    places = [m.span() for m in WORD_OF_TEXT.finditer(text)]
    return [(places[first][0], places[last][1]) for first, last in runs]


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.int64())),
    ]
)
RESULT_SQL = (
    "doc_id bigint, n_words bigint, runs array<struct<first: bigint, last: bigint>>, "
    "spans array<struct<start: bigint, end: bigint>>, items array<bigint>"
)


def _rows(ids, found, texts):
    spans = [original_spans(t, runs) for (_, runs, _), t in zip(found, texts, strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array([n for n, _, _ in found], pa.int64()),
            pa.array([[{"first": a, "last": b} for a, b in runs] for _, runs, _ in found], RESULT.field("runs").type),
            pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], RESULT.field("spans").type),
            pa.array([items for _, _, items in found], RESULT.field("items").type),
        ],
        schema=RESULT,
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: words, runs of hit words, their spans in the original, item ids."""
    texts = texts_of(docs, id_col, text_col)
    blocks = pattern_blocks(texts_of(items, item_id_col, item_text_col), window, block_chars)
    first = next(blocks)
    result = texts.mapInArrow(_first_pass(first), RESULT_SQL)
    later = next(blocks, None)
    if later is None:
        return result
    # Further blocks: the runs found so far stay beside the text, and each pass adds to them.
    so_far = texts.mapInArrow(_next_pass(first), "doc_id bigint, text string, " + FOUND)
    while later:
        so_far = kept(so_far, "decontam").mapInArrow(
            _next_pass(later), "doc_id bigint, text string, " + FOUND
        )
        later = next(blocks, None)
    return so_far.mapInArrow(_finish, RESULT_SQL)


def _first_pass(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton_of(block)
        for ids, texts in rows_of(batches):
            yield _rows(ids, [scan(t, machine) for t in texts], texts)

    return run


def _next_pass(block):
    hits_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton_of(block)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [scan(t, machine) for t in texts]
            old_runs, old_items = [[]] * len(texts), [[]] * len(texts)
            if batch.num_columns > 2:
                old_runs = [[(r["first"], r["last"]) for r in x] for x in batch.column(3).to_pylist()]
                old_items = batch.column(4).to_pylist()
            runs = [merge_runs([*old, *new]) for old, (_, new, _) in zip(old_runs, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[{"first": a, "last": b} for a, b in r] for r in runs], hits_type),
                    pa.array([in_order([*old, *new]) for old, (_, _, new) in zip(old_items, found, strict=True)], pa.list_(pa.int64())),
                ],
                ["doc_id", "text", "n_words", "hits", "items"],
            )

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        runs = [[(r["first"], r["last"]) for r in x] for x in batch.column(3).to_pylist()]
        found = list(zip(batch.column(2).to_pylist(), runs, batch.column(4).to_pylist(), strict=True))
        yield _rows(batch.column(0), found, texts)


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", **item_columns: str) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns unchanged, each row judged for itself."""
    blocks = pattern_blocks(
        texts_of(items, item_columns.get("item_id_col", "item_id"), item_columns.get("item_text_col", "text")),
        window, BLOCK_CHARS,
    )
    bound_batches(docs.sparkSession)
    clean = docs
    place = docs.columns.index(text_col)
    for block in blocks:
        clean = clean.mapInArrow(_clean_rows(block, place), docs.schema)
    return clean


def _clean_rows(block, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton_of(block)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                clean = [not scan(t or "", machine)[2] for t in piece.column(place).to_pylist()]
                yield piece.filter(pa.array(clean, pa.bool_()))

    return run


def summary(found: DataFrame) -> DataFrame:
    """The counts and digests of ``contamination``'s rows."""
    hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, r: a + r["last"] - r["first"] + 1)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"), "spans",
    )
