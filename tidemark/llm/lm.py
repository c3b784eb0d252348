"""A hashed maximum-entropy language model, trained and scored in numpy batches.

Tokens are the words of a text (A-Z lower-cased) and one end. A token's symbol is its place among
the ``HEAD`` most frequent words, or a cell of the tail that its first and last bytes name, so words
that never occurred have a symbol too. With 32 classes of 32 members,

    P(token | context) = P(class | context) P(member | class, context) P(token | symbol)

The first two are softmaxes over hashed features of the three symbols before (previous, pair of
previous, two skips), on top of the exact unigram as reference distribution; the last is the smoothed
share of the token in its symbol, with one share for all unknown tokens, so the whole sums to one.

Training covers every token of every learning document once, in ``ROUNDS`` slices by a hash of the
document id. In a round the tasks sum, for every feature row and outcome, how often it was seen and how
often the model of the round before expects it; their difference is the gradient. Sums are added block
by block in a shuffle, and each weight takes a step along its gradient, scaled so that its own
observed and expected counts would meet (``log(seen / expected)``), shared by the features that act
together. Sums do not depend on how documents are dealt to tasks, so neither does the model, but for
the rounding of floating-point sums. Only the model, of fixed size, passes through the driver.

Counts are exact and joined, not broadcast: documents are encoded in chunks of bounded size, a chunk
sends each of its distinct tokens once, with its count, and gets back the count over all chunks.

Null and empty texts have the end alone. A null id is never held out. Repeated rows are learnt from
and scored each for itself; extra columns are not looked at. Without learning documents every token
is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.batches import bound_batches, kept

WIDTH = 32
HEAD = 16 * WIDTH
SYMBOLS = WIDTH * WIDTH
START = SYMBOLS
CLASS_ROWS, MEMBER_ROWS = 1 << 14, 1 << 15
ROUNDS = 4
#: Steps of the rounds, and the count that every observed and expected count gets on top.
RATE = 1.0
PRIOR = 1.0
BATCH = 8192
CHUNK_TOKENS = 1_200_000
#: Tokens of a training task, about; it bounds the sums that are shuffled, not what is learnt.
TASK_TOKENS = 4_000_000
BLOCKS = 48
ONES = np.ones(WIDTH, np.float32)


# ---- encoding -----------------------------------------------------------------------------------


class Buckets(dict):
    """Piece of at most two bytes -> its bucket; so there are never more than some 65,000."""

    def __init__(self, seed: int, size: int):
        super().__init__()
        self.seed, self.size = seed, size

    def __missing__(self, piece: bytes) -> int:
        self[piece] = n = xxhash.xxh64_intdigest(piece, seed=self.seed) % self.size
        return n


ENDS, BEGINS = Buckets(1, WIDTH - HEAD // WIDTH), Buckets(2, WIDTH)


def tail_cell(token: bytes) -> int:
    """The symbol of a token outside the head: what it ends and begins with."""
    return HEAD + ENDS[token[-2:]] * WIDTH + BEGINS[token[:2]]


class LocalIds(dict):
    def __missing__(self, token: bytes) -> int:
        self[token] = n = len(self)
        return n


CHUNK_SQL = (
    "chunk bigint, doc_ids array<bigint>, held binary, sizes binary, codes binary, hashes binary, "
    "tokens array<binary>, counts array<bigint>, cells array<int>"
)


def packed(codes: np.ndarray) -> bytes:
    """32-bit numbers, byte plane after byte plane, compressed: the upper planes are almost empty."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def encode_chunks(chunk_tokens: int):
    """Documents become numbers into the chunk's own list of distinct tokens."""

    def close(chunk: int, ids: list, held: list, codes: list, local: LocalIds) -> pa.RecordBatch:
        sizes = np.array([len(c) for c in codes], np.int64)
        flat = np.concatenate(codes)
        learns = np.repeat(~np.array(held, bool), sizes)
        tokens = list(local)
        one = lambda x, kind=pa.binary(): pa.array([x], kind)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
        counts = np.bincount(flat[learns], minlength=len(tokens))
        cells = np.fromiter(map(tail_cell, tokens), np.int32, len(tokens))
        offsets = pa.array([0, len(tokens)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                one(chunk, pa.int64()), one(ids, pa.list_(pa.int64())), one(np.array(held, bool).tobytes()),
                one(sizes.tobytes()), one(packed(flat)), one(hashes.tobytes()),
                one(tokens, pa.list_(pa.binary())),
                pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(cells, pa.int32())),
            ],
            ["chunk", "doc_ids", "held", "sizes", "codes", "hashes", "tokens", "counts", "cells"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        ids, held, codes, local, size = [], [], [], LocalIds(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                rows = zip(*[c.to_pylist() for c in piece.columns], strict=True)
                for doc_id, out, text in rows:
                    words = text.encode().lower().split()
                    words.append(b"")
                    codes.append(np.fromiter(map(local.__getitem__, words), np.int64, len(words)))
                    ids.append(doc_id)
                    held.append(out)
                    size += len(words)
                    if size >= chunk_tokens:
                        yield close(chunk, ids, held, codes, local)
                        chunk += 1
                        ids, held, codes, local, size = [], [], [], LocalIds(), 0
        if codes:
            yield close(chunk, ids, held, codes, local)

    return run


def chunks_of(
    docs: DataFrame, chunk_tokens: int = CHUNK_TOKENS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The encoded documents, written. Held out: crc32 of the id as text leaves 1 divided by 5."""
    bound_batches(docs.sparkSession)
    doc_id = F.col(id_col).cast("bigint")
    held = F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))
    rows = docs.select(doc_id.alias("doc_id"), held.alias("held"), F.coalesce(text_col, F.lit("")).alias("text"))
    return kept(rows.mapInArrow(encode_chunks(chunk_tokens), CHUNK_SQL), "lm-chunks")


def counted_tokens(chunks: DataFrame) -> DataFrame:
    """(chunk, pos, c, lead): the count over all learning documents for every token of every chunk.

    A token's group holds one row per chunk with it, a small share of all rows for any token.
    ``lead`` is the token and its cell in one of its rows, null in the others.
    """
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("tokens", "counts", "cells")).alias("pos", "x"))
    rows = each.select("chunk", "pos", "x.tokens", "x.counts", "x.cells")
    order = Window.partitionBy("tokens").orderBy("chunk", "pos")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lead = F.struct(F.col("tokens").alias("token"), F.col("cells").alias("cell"))
    counted = rows.select(
        "chunk", "pos", F.sum("counts").over(whole).alias("c"),
        F.when(F.row_number().over(order) == 1, lead).alias("lead"),
    )
    return kept(counted, "lm-counts")


# ---- model --------------------------------------------------------------------------------------


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass
class Lexicon:
    """What is known of the vocabulary as a whole; its size does not depend on the corpus."""

    total: int
    distinct: int
    head_hashes: np.ndarray
    cell_tokens: np.ndarray
    cell_distinct: np.ndarray

    def symbols(self, hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The symbol of every token of a chunk."""
        if not len(self.head_hashes):
            return cells.astype(np.int64)
        order = np.argsort(self.head_hashes)
        place = np.searchsorted(self.head_hashes, hashes, sorter=order)
        found = order[np.minimum(place, len(order) - 1)]
        return np.where(self.head_hashes[found] == hashes, found, cells).astype(np.int64)

    def mass(self) -> np.ndarray:
        """The smoothed number of tokens of each symbol; places of the head without a word get almost none."""
        mass = self.cell_tokens + 0.5 * (self.cell_distinct + 1)
        mass[:HEAD] = np.where(self.cell_tokens[:HEAD] > 0, self.cell_tokens[:HEAD], 1e-6)
        return mass

    def share(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Natural log of P(token | symbol)."""
        whole = self.cell_tokens[symbols] + 0.5 * (self.cell_distinct[symbols] + 1)
        return np.where(symbols < HEAD, 0.0, np.log((counts + 0.5) / whole))


def lexicon_of(counted: DataFrame) -> Lexicon:
    """Totals, the most frequent words and the sums per cell: rows of a fixed number."""
    known = counted.filter("lead IS NOT NULL AND c > 0").select("lead.token", "lead.cell", "c")
    head = known.orderBy(F.col("c").desc(), "token").limit(HEAD).collect()
    tokens, distinct = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for row in known.groupBy("cell").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).collect():
        tokens[row.cell], distinct[row.cell] = row.n, row.v
    total, words = int(tokens.sum()), int(distinct.sum())
    for place, row in enumerate(head):
        tokens[row.cell] -= row.c
        distinct[row.cell] -= 1
        tokens[place], distinct[place] = row.c, 1
    hashes = np.array([xxhash.xxh64_intdigest(bytes(r.token)) for r in head], np.uint64)
    return Lexicon(total, words, hashes, tokens, distinct)


class Model:
    """Weights of both softmaxes over hashed features, and the reference distribution."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray | None = None):
        self.lexicon = lexicon
        size = (CLASS_ROWS + MEMBER_ROWS) * WIDTH
        self.weights = np.zeros(size, np.float32) if weights is None else weights
        self.classes = self.weights[: CLASS_ROWS * WIDTH].reshape(CLASS_ROWS, WIDTH)
        self.members = self.weights[CLASS_ROWS * WIDTH :].reshape(MEMBER_ROWS, WIDTH)
        mass = lexicon.mass().reshape(WIDTH, WIDTH)
        self.class_base = np.log(mass.sum(axis=1) / mass.sum()).astype(np.float32)
        self.member_base = np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32)
        symbols = np.arange(SYMBOLS + 1, dtype=np.uint64)
        self.single = [(mix(symbols, k << 32) % np.uint64(CLASS_ROWS)).astype(np.uint16) for k in (1, 2, 3)]
        pairs = np.arange(WIDTH, dtype=np.uint64)[:, None] * np.uint64(SYMBOLS + 1) + symbols
        self.within = [(mix(pairs, k << 32) % np.uint64(MEMBER_ROWS)).astype(np.uint16) for k in (4, 5)]

    def features(self, before: list[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the class softmax and of the member softmax for each token."""
        one, two, three = before
        pair = mix(two.astype(np.uint64) * np.uint64(SYMBOLS + 1) + one.astype(np.uint64), 6 << 32)
        of_class = [self.single[0][one], self.single[1][two], self.single[2][three], (pair % np.uint64(CLASS_ROWS)).astype(np.uint16)]
        c = target // WIDTH
        return np.stack(of_class, axis=1), np.stack([self.within[0][c, one], self.within[1][c, two]], axis=1)


def raised(weights: np.ndarray, rows: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The scores of all outcomes, lowered by the greatest of each row, or of all where all are near."""
    scores = weights.take(rows[:, 0], axis=0)
    for j in range(1, rows.shape[1]):
        scores += weights.take(rows[:, j], axis=0)
    scores += base
    if not scores.size:
        return scores
    greatest = scores.max()
    # Within this range no sum of exponentials is lost.
    scores -= greatest if greatest - scores.min() < 60 else scores.max(axis=1, keepdims=True)
    return scores


def log_softmax(weights: np.ndarray, rows: np.ndarray, base: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each row's outcome."""
    scores = raised(weights, rows, base)
    chosen = scores[np.arange(len(target)), target]
    return chosen - np.log(np.exp(scores, out=scores) @ ONES)


def run_sums(x: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sums of ``x.take(rows, axis=0)`` over runs that begin at ``starts``.

    Neighbours of a run are added in pairs until one is left, so that whole rows are added at once;
    ``reduceat`` goes through every run column by column. Runs of one are set aside.
    """
    sums = np.empty((len(starts), x.shape[1]), x.dtype)
    runs, sizes = np.arange(len(starts)), np.diff(starts, append=len(rows))
    while True:
        single = sizes == 1
        sums[runs[single]] = x.take(rows[starts[single]], axis=0)
        longer = ~single
        if not longer.any():
            return sums
        runs, starts, sizes = runs[longer], starts[longer], sizes[longer]
        halves = (sizes + 1) >> 1
        ends = np.cumsum(halves)
        first = np.repeat(starts - 2 * (ends - halves), halves) + 2 * np.arange(ends[-1])
        added = x.take(rows[first], axis=0)
        # The last of an odd run has no partner: what is added to it is undone.
        last = (ends - 1)[sizes % 2 == 1]
        first += 1
        first[last] -= 1
        kept_last = added[last]
        added += x.take(rows[first], axis=0)
        added[last] = kept_last
        x, rows, starts, sizes = added, np.arange(len(added)), ends - halves, halves


def add_expected(sums: np.ndarray, weights: np.ndarray, rows: np.ndarray, base: np.ndarray) -> None:
    """Add the outcome probabilities of a batch to the feature rows that occur in it."""
    likely = raised(weights, rows, base)
    np.exp(likely, out=likely)
    likely /= (likely @ ONES)[:, None]
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    cuts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    sums[ranked[cuts]] += run_sums(likely, order // rows.shape[1], cuts)


def add_seen(sums: np.ndarray, rows: np.ndarray, outcome: np.ndarray) -> None:
    """Count the outcomes of a chunk under each of their feature rows."""
    for j in range(rows.shape[1]):
        sums += np.bincount(rows[:, j].astype(np.int64) * WIDTH + outcome, minlength=len(sums))


def contexts(symbols: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The symbols one, two and three tokens before each token, within its document."""
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(symbols)) - starts
    found = []
    for k in (1, 2, 3):
        shifted = np.concatenate((np.full(k, START), symbols))[: len(symbols)]
        found.append(np.where(place >= k, shifted, START))
    return found


class Chunk:
    """One row of the chunk table, opened."""

    def __init__(self, row: dict, cells: np.ndarray, lexicon: Lexicon):
        self.held = np.frombuffer(row["held"], bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.codes = unpacked(row["codes"])
        self.vocabulary = lexicon.symbols(np.frombuffer(row["hashes"], np.uint64), cells)
        self.symbols = self.vocabulary[self.codes]


def _numpy(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def slices_of(doc_ids: list, rounds: int) -> np.ndarray:
    """The round in which each document is learnt from, by its id alone."""
    ids = np.array([0 if d is None else d for d in doc_ids], np.int64).view(np.uint64)
    return (mix(ids, 7 << 32) % np.uint64(rounds)).astype(np.int64)


SUMS_SQL = "block int, seen binary, expected binary"
SUMS = pa.schema([("block", pa.int32()), ("seen", pa.binary()), ("expected", pa.binary())])


def sums_of_round(lexicon: Lexicon, weights: np.ndarray, turn: int, rounds: int):
    """Seen and expected counts of every weight over a task's documents of the round, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(lexicon, weights)
        seen, expected = np.zeros(len(weights)), np.zeros(len(weights))
        cut, learnt = CLASS_ROWS * WIDTH, 0
        classes, members = expected[:cut].reshape(-1, WIDTH), expected[cut:].reshape(-1, WIDTH)
        for batch in batches:
            for i in range(batch.num_rows):
                piece = batch.slice(i, 1)
                row = {n: piece.column(n)[0].as_py() for n in ("doc_ids", "held", "sizes", "codes", "hashes")}
                chunk = Chunk(row, _numpy(piece.column("cells")), lexicon)
                docs = ~chunk.held & (slices_of(row["doc_ids"], rounds) == turn)
                if not docs.any():
                    continue
                target = chunk.symbols[np.repeat(docs, chunk.sizes)]
                of_class, of_member = model.features(contexts(target, chunk.sizes[docs]), target)
                learnt += len(target)
                outer, inner = target // WIDTH, target % WIDTH
                add_seen(seen[:cut], of_class, outer)
                add_seen(seen[cut:], of_member, inner)
                for at in range(0, len(target), BATCH):
                    part = slice(at, at + BATCH)
                    add_expected(classes, model.classes, of_class[part], model.class_base)
                    add_expected(members, model.members, of_member[part], model.member_base[outer[part]])
        if learnt:
            split = lambda x: [zstandard.compress(b.astype(np.float32).tobytes(), 1) for b in np.array_split(x, BLOCKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BLOCKS), pa.int32()), pa.array(split(seen), pa.binary()), pa.array(split(expected), pa.binary())],
                schema=SUMS,
            )

    return run


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each block over all tasks, as they come."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            for place, name in enumerate(("seen", "expected")):
                part = np.frombuffer(zstandard.decompress(row[name]), np.float32).astype(np.float64)
                held = sums.setdefault(row["block"], [np.zeros(len(part)), np.zeros(len(part))])
                held[place] += part
    rows = [{"block": b, "seen": x.tobytes(), "expected": y.tobytes()} for b, (x, y) in sums.items()]
    yield pa.RecordBatch.from_pylist(rows, SUMS)


def train(chunks: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """Weights after one pass over all learning documents, a slice of them a round."""
    weights = np.zeros((CLASS_ROWS + MEMBER_ROWS) * WIDTH, np.float32)
    if not lexicon.total:
        return weights
    # Features that act on one softmax share a step.
    shared = np.repeat([4.0, 2.0], [CLASS_ROWS * WIDTH, MEMBER_ROWS * WIDTH])
    columns = chunks.select("doc_ids", "held", "sizes", "codes", "hashes", "cells")
    tasks = max(1, -(-lexicon.total // TASK_TOKENS))
    for turn in range(rounds):
        sums = columns.coalesce(tasks).mapInArrow(sums_of_round(lexicon, weights, turn, rounds), SUMS_SQL)
        rows = sorted(sums.repartition("block").mapInArrow(added, SUMS_SQL).collect(), key=lambda r: r.block)
        if rows:
            seen, expected = (np.concatenate([np.frombuffer(r[n]) for r in rows]) for n in ("seen", "expected"))
            step = np.log((seen + PRIOR) / (expected + PRIOR)) / shared
            weights = (weights + rate * step).astype(np.float32)
    return weights


# ---- scores -------------------------------------------------------------------------------------

SCORE = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)
SCORE_SQL = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def token_scores(model: Model, chunk: Chunk, counts: np.ndarray) -> np.ndarray:
    """Natural log of P(token | context) for every token of a chunk."""
    target = chunk.symbols
    before = contexts(target, chunk.sizes)
    result = model.lexicon.share(chunk.vocabulary, counts)[chunk.codes]
    for at in range(0, len(target), BATCH):
        part = slice(at, at + BATCH)
        goal = target[part]
        outer, inner = goal // WIDTH, goal % WIDTH
        of_class, of_member = model.features([b[part] for b in before], goal)
        result[part] += log_softmax(model.classes, of_class, model.class_base, outer)
        result[part] += log_softmax(model.members, of_member, model.member_base[outer], inner)
    return result


def score_chunks(lexicon: Lexicon, weights: np.ndarray):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model = Model(lexicon, weights)
        found = []
        for i in range(left.num_rows):
            row = {n: left.column(n)[i].as_py() for n in ("doc_ids", "held", "sizes", "codes", "hashes")}
            cells = _numpy(left.column("cells").combine_chunks().slice(i, 1))
            chunk = Chunk(row, cells, lexicon)
            counts = np.zeros(len(cells), np.int64)
            counts[right.column("pos").to_numpy()] = right.column("c").to_numpy()
            whole = lexicon.total + 0.5 * (lexicon.distinct + 1)
            base = np.log10((counts + 0.5) / whole)[chunk.codes]
            scores = token_scores(model, chunk, counts) / np.log(10)
            starts = np.cumsum(chunk.sizes) - chunk.sizes
            add = lambda x: np.add.reduceat(x, starts)
            found.append(
                pa.Table.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(chunk.held),
                        pa.array(chunk.sizes), pa.array(add((counts > 0)[chunk.codes].astype(np.int64))),
                        pa.array(np.full(len(starts), lexicon.total)), pa.array(add(base)), pa.array(add(scores)),
                    ],
                    schema=SCORE,
                )
            )
        return pa.concat_tables(found) if found else SCORE.empty_table()

    return run


def score(docs: DataFrame, rounds: int = ROUNDS, chunk_tokens: int = CHUNK_TOKENS, **columns: str) -> DataFrame:
    """Train on the learning documents of ``docs`` and score all of them; one row per row."""
    chunks = chunks_of(docs, chunk_tokens, **columns)
    counted = counted_tokens(chunks)
    lexicon = lexicon_of(counted)
    weights = train(chunks, lexicon, rounds)
    left = chunks.select("chunk", "doc_ids", "held", "sizes", "codes", "hashes", "cells")
    pairs = left.groupBy("chunk").cogroup(counted.select("chunk", "pos", "c").groupBy("chunk"))
    return pairs.applyInArrow(score_chunks(lexicon, weights), SCORE_SQL)
