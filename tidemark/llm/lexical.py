"""Ranked lexical search with geometric blocks in every posting list and exact bounds.

Documents are dealt into index shards. A shard holds, for the terms of the queries, the documents as
sparse vectors of impacts and one posting list per term. A list longer than ``BLOCK`` is clustered:
documents are projected to a few dimensions by signed hashing of their weighted impacts, every
``BLOCK``-th posting is a centre, and each posting joins the centre most like it. A block keeps the
coordinatewise maximum of its documents' impacts, over all their terms.

A query takes its terms in the order of what they can add at most. In the list of term i, documents
with an earlier term have been dealt with, so a block's bound is the sum of its maxima over the terms
from i on; the block is skipped only where this integer bound is below the k-th best score so far.
Equal scores are not skipped, since a smaller id may win. Whole lists are skipped by the same rule, and
the best scores travel from shard to shard within a task. No document is dropped for any other reason.

Queries are the stated set: they are taken in blocks of at most ``QUERY_BYTES`` of text on average,
each a pass over the documents, so that what travels to the tasks is bounded.

Null texts have no terms; rows that share a doc_id or an item_id are documents or queries of their own;
a null doc_id comes last among equal scores; an item without a match has no rows; empty tables give an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.batches import WORD_BYTES, bound_batches, kept, rows_of

TOP = 50
BLOCK = 128
DIMENSIONS = 32
SHARD_DOCS = 1 << 13
SHARD_ENTRIES = 1 << 20
CELLS = 1 << 22
QUERY_BYTES = 8 << 20
VECTORS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
FOUND = "query int, item_id bigint, doc_id bigint, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Length and counts of the vocabulary's terms, for every document."""
    bound_batches(docs.sparkSession)
    lists = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for ids, texts in rows_of(batches):
            sizes, terms, tfs = [], [], []
            for text in texts:
                words = terms_of(text)
                sizes.append(len(words))
                known = np.array([i for i in map(get, words) if i is not None], np.int32)
                found, times = np.unique(known, return_counts=True)
                terms.append(found)
                tfs.append(times.astype(np.int32))
            columns = [ids, pa.array(sizes, pa.int64()), pa.array(terms, lists), pa.array(tfs, lists)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    return texts.mapInArrow(run, VECTORS)


@dataclass(frozen=True)
class Corpus:
    """What the weights need of all documents."""

    documents: int
    words: int
    weights: np.ndarray

    def impacts(self, tfs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        m = 50 + (50 * sizes * self.documents) // max(1, self.words)
        return (1_000_000_000 * tfs) // (1000 * tfs + 20 * m)


def corpus_of(rows: DataFrame, size: int) -> Corpus:
    """Counts over all documents; the list of document frequencies is as long as the vocabulary."""
    total = rows.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    counts = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    df = dict(map(tuple, counts))
    weights = [math.floor(1000 * math.log((2 * total.n + 2) / (2 * df.get(t, 0) + 1))) for t in range(size)]
    return Corpus(total.n, total.l, np.array(weights, np.int64))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Shard:
    """One index shard; terms are numbered by their place in ``terms``."""

    ids: np.ndarray
    unnamed: np.ndarray
    at: np.ndarray  # entries of document d: at[d] to at[d + 1]
    entry_term: np.ndarray
    entry_impact: np.ndarray
    terms: np.ndarray
    list_at: np.ndarray
    postings: np.ndarray  # per list, ordered by block
    list_max: np.ndarray
    blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def build(ids, unnamed, at, terms, impacts, corpus: Corpus, block: int = BLOCK) -> Shard:
        names, term = np.unique(terms, return_inverse=True)
        n, t = len(ids), len(names)
        owner = np.repeat(np.arange(n), np.diff(at))
        by_term = np.argsort(term, kind="stable")
        postings = owner[by_term]
        list_at = np.searchsorted(term[by_term], np.arange(t + 1))
        list_max = np.maximum.reduceat(impacts[by_term], list_at[:-1]) if t else np.empty(0, np.int64)
        space = projected(owner, terms, corpus.weights[terms] * impacts, n)
        blocks = {}
        for i in np.flatnonzero(np.diff(list_at) > block):
            docs = postings[list_at[i] : list_at[i + 1]]
            label = np.argmax(space[docs] @ space[docs[::block]].T, axis=1)
            order = np.argsort(label, kind="stable")
            docs, label = docs[order], label[order]
            postings[list_at[i] : list_at[i + 1]] = docs
            cut = np.append(np.flatnonzero(np.diff(label, prepend=-1)), len(docs))
            blocks[int(i)] = (cut, *maxima(docs, cut, at, term, impacts, t))
        return Shard(ids, unnamed, at, term, impacts, names, list_at, postings, list_max, blocks)

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        lengths = self.at[docs + 1] - self.at[docs]
        entries = ranges(self.at[docs], lengths)
        gains = weights[self.entry_term[entries]] * self.entry_impact[entries]
        return np.add.reduceat(gains, np.cumsum(lengths) - lengths) if len(docs) else np.empty(0, np.int64)


def maxima(docs, cut, at, term, impacts, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of every block, terms, coordinatewise maxima); so many cells are filled at a time."""
    step, lengths = max(1, CELLS // t), at[docs + 1] - at[docs]
    sizes, terms, peaks = [], [], []
    for first in range(0, len(cut) - 1, step):
        edges = cut[first : first + step + 1]
        inside, n = slice(edges[0], edges[-1]), len(edges) - 1
        entries = ranges(at[docs[inside]], lengths[inside])
        cell = np.repeat(np.repeat(np.arange(n), np.diff(edges)), lengths[inside]) * t + term[entries]
        peak = np.zeros(n * t, np.int64)
        np.maximum.at(peak, cell, impacts[entries])
        filled = np.flatnonzero(peak)
        sizes.append(np.bincount(filled // t, minlength=n))
        terms.append((filled % t).astype(np.int32))
        peaks.append(peak[filled].astype(np.int32))  # an impact is at most a million
    sizes = np.concatenate(sizes)
    return np.cumsum(sizes) - sizes, np.concatenate(terms), np.concatenate(peaks)


def projected(owner: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Documents as unit vectors of a few dimensions; every term has a fixed place and sign."""
    mixed = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    place = (mixed % np.uint64(DIMENSIONS)).astype(np.int64)
    sign = np.where(mixed >> np.uint64(12) & np.uint64(1), 1.0, -1.0)
    flat = np.bincount(owner * DIMENSIONS + place, values * sign, n * DIMENSIONS)
    space = flat.reshape(n, DIMENSIONS).astype(np.float32)
    return space / np.maximum(np.linalg.norm(space, axis=1, keepdims=True), 1e-9)


@dataclass
class Best:
    """The best documents of one query so far."""

    k: int
    score: np.ndarray
    unnamed: np.ndarray
    ids: np.ndarray
    scored: int = 0  # documents whose score was computed

    @staticmethod
    def empty(k: int) -> Best:
        return Best(k, np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))

    @property
    def floor(self) -> int:
        """No document below this score is wanted."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score, unnamed, ids) -> None:
        self.scored += len(score)
        good = score >= self.floor
        score = np.concatenate([self.score, score[good]])
        unnamed, ids = np.concatenate([self.unnamed, unnamed[good]]), np.concatenate([self.ids, ids[good]])
        first = np.lexsort((ids, unnamed, -score))[: self.k]
        self.score, self.unnamed, self.ids = score[first], unnamed[first], ids[first]


def search_shard(shard: Shard, query: np.ndarray, corpus: Corpus, best: Best) -> None:
    """Add the shard's documents to the best of one query (term numbers of the vocabulary)."""
    place = np.searchsorted(shard.terms, query)
    place = place[(place < len(shard.terms)) & (shard.terms[np.minimum(place, len(shard.terms) - 1)] == query)]
    gain = corpus.weights[shard.terms[place]] * shard.list_max[place]
    order = np.argsort(-gain, kind="stable")
    place, gain = place[order], gain[order]
    left = np.cumsum(gain[::-1])[::-1]
    weights = np.zeros(len(shard.terms), np.int64)
    weights[place] = corpus.weights[shard.terms[place]]
    open_weights = weights.copy()  # of the terms whose list is still to come
    seen = np.zeros(len(shard.ids), bool)

    def visit(docs):
        docs = docs[~seen[docs]]
        seen[docs] = True
        best.add(shard.scores(docs, weights), shard.unnamed[docs], shard.ids[docs])

    for i, term in enumerate(place.tolist()):
        if left[i] < best.floor:
            return
        docs = shard.postings[shard.list_at[term] : shard.list_at[term + 1]]
        if term not in shard.blocks:
            visit(docs)
        else:
            cut, at, terms, peaks = shard.blocks[term]
            bounds = np.add.reduceat(peaks * open_weights[terms], at)
            number = np.repeat(np.arange(len(bounds)), np.diff(cut))
            # The most promising blocks first: they raise the floor for the rest.
            rank = np.argsort(-bounds, kind="stable")
            for some in (rank[:2], rank[2:]):
                wanted = np.zeros(len(bounds), bool)
                wanted[some] = bounds[some] >= best.floor
                if wanted.any():
                    visit(docs[wanted[number]])
        open_weights[term] = 0


def shards_of(batches: Iterator[pa.RecordBatch], corpus: Corpus) -> Iterator[Shard]:
    """Index shards of the documents of one task."""
    parts, docs, entries = [], 0, 0

    def close():
        ids = pa.concat_arrays([p.column(0) for p in parts])
        sizes = np.concatenate([p.column(1).to_numpy() for p in parts])
        lengths = np.concatenate([np.diff(p.column(2).offsets.to_numpy()) for p in parts]).astype(np.int64)
        flat = [np.concatenate([p.column(c).flatten().to_numpy() for p in parts]) for c in (2, 3)]
        at = np.concatenate([[0], np.cumsum(lengths)])
        impacts = corpus.impacts(flat[1].astype(np.int64), np.repeat(sizes, lengths))
        return Shard.build(
            ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), at, flat[0], impacts, corpus
        )

    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            piece = batch.slice(start, 256)
            parts.append(piece)
            docs += piece.num_rows
            entries += len(piece.column(2).flatten())
            if docs >= SHARD_DOCS or entries >= SHARD_ENTRIES:
                yield close()
                parts, docs, entries = [], 0, 0
    if docs:
        yield close()


def best_of_tasks(rows: DataFrame, queries: list[tuple[int | None, np.ndarray]], corpus: Corpus, k: int) -> DataFrame:
    """The best ``k`` of every query in every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best.empty(k) for _ in queries]
        for shard in shards_of(batches, corpus):
            for (_, terms), b in zip(queries, best, strict=True):
                search_shard(shard, terms, corpus, b)
        for number, ((item, _), b) in enumerate(zip(queries, best, strict=True)):
            n = len(b.score)
            if n:
                columns = [
                    pa.array(np.full(n, number, np.int32)), pa.array([item] * n, pa.int64()),
                    pa.array(b.ids, mask=b.unnamed), pa.array(b.score),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["query", "item_id", "doc_id", "score"])

    return rows.filter(F.size("terms") > 0).mapInArrow(run, FOUND)


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, query_bytes: int = QUERY_BYTES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    asked = items.select(
        F.col(item_col).cast("bigint").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")
    )
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // query_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    results = []
    for b in range(blocks):
        vocabulary: dict[bytes, int] = {}
        queries = []
        for row in asked.filter(block == b).collect():
            terms = {vocabulary.setdefault(w, len(vocabulary)) for w in terms_of(row.text.encode())}
            queries.append((row.item_id, np.array(sorted(terms), np.int32)))
        rows = kept(vectors(docs, vocabulary, id_col, text_col), "vectors")
        found = best_of_tasks(rows, queries, corpus_of(rows, len(vocabulary)), k)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        results.append(ranked.select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, results)
