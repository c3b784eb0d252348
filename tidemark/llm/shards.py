"""Token ids in binary shards with a minimal perfect hash index over the document keys.

Format: a Parquet table of shards in key order. A row holds one shard:

* ``payload``: the ids of its documents one after another, raw little-endian ``u2`` or ``u4``
  (``width`` says which; two bytes where the vocabulary allows it), each document with its end id;
* ``ends``: the documents' end offsets in ids, ``<u8``, in payload order;
* ``keys``: their keys, ``<i8``, in payload order; ``valid`` marks the keys that are not null;
* ``levels``, ``bits``: the hash, see ``MinimalHash``; ``slots``: slot -> (first document, number of
  documents), ``<u4`` pairs; ``prints``: slot -> 32-bit fingerprint of its key;
* ``part``, ``seq``, ``part_start``: its place, and the ids before it in its range of keys.

A key is found in constant time: a few bit tests give its slot, the fingerprint refuses most absent
keys and the stored key the rest, the slot gives the offsets. Shards close at ``SHARD_IDS`` ids, so
neither writer nor reader holds more than one shard and one document.

Ids are those of the library's ``encode`` without tokens put around: added tokens of the file that
are spelled in a text keep their ids.

Null texts are empty and hold the end id alone. Rows with a null key come first and cannot be looked
up. Rows that share a key are neighbours, ordered by text; a look-up gives all of them.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.batches import rows_of, texts_of
from tidemark.llm.pretokens import SPLIT, MatchEncoder, spelled

SHARD_IDS = 2_000_000
#: Bits per key and level: more bits, fewer levels.
SPREAD = 2


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over ``keys`` and a seed."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinimalHash:
    """A bijection from n distinct keys to 0..n-1 in about three bits a key.

    Each level is a bit array; a key whose place no other key shares sets its bit and is done, the
    others go to the next level. The slot is the number of set bits before the key's bit.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.ranks = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @classmethod
    def of(cls, keys: np.ndarray) -> MinimalHash:
        rest, sizes, levels = keys, [], []
        while len(rest):
            size = max(8, SPREAD * len(rest))
            place = mix(rest, len(sizes)) % np.uint64(size)
            times = np.bincount(place.astype(np.int64), minlength=size)
            levels.append(times == 1)
            sizes.append(size)
            rest = rest[times[place.astype(np.int64)] > 1]
        return cls(np.array(sizes, np.int64), np.concatenate([*levels, np.zeros(0, bool)]))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; for keys outside the set, any slot or -1."""
        found = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            place = (mix(keys[rest], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = self.bits[place]
            found[rest[hit]] = self.ranks[place[hit]]
            rest = rest[~hit]
        return found


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class Tokens:
    """The encoder of one tokenizer file; workers build it once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.size = tokenizer.get_vocab_size()
        model = tokenizer.model
        plain = self.is_byte_level(tokenizer)
        if not plain:
            raise ValueError("a byte-level BPE tokenizer without a normaliser is needed")
        self.between = MatchEncoder(
            SPLIT, lambda match: [t.id for t in model.tokenize(spelled(match))]
        )
        added = {t.content: (i, t) for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.tokenizer, self.added = tokenizer, {c: array("I", [i]).tobytes() for c, (i, _) in added.items()}
        #: Tokens that take blanks beside them, or stand between words alone, are left to the library.
        self.simple = not any(t.lstrip or t.rstrip or t.single_word for _, t in added.values())
        # The leftmost and longest first; those that the normaliser passes over before the others.
        first, then = ([c for c, (_, t) in added.items() if c and t.normalized == n] for n in (False, True))
        self.cuts = [self.cutter(contents).split for contents in (first, then) if contents]

    @staticmethod
    def cutter(contents: list[str]) -> re.Pattern:
        return re.compile(f"({'|'.join(map(re.escape, sorted(contents, key=len, reverse=True)))})")

    def encode(self, text: str) -> bytes:
        """The ids of ``Tokenizer.encode(text, add_special_tokens=False)``, as native 32-bit integers.

        Added tokens are cut out first, the pieces between them are encoded match by match.
        """
        if not any(content in text for content in self.added):
            return self.between(text)
        if not self.simple:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        pieces = [(text, False)]
        for cut in self.cuts:
            pieces = [
                new for piece, known in pieces
                for new in ([(piece, True)] if known else [(x, i % 2 == 1) for i, x in enumerate(cut(piece))])
            ]
        return b"".join([self.added[x] if known else self.between(x) for x, known in pieces])

    @staticmethod
    def is_byte_level(tokenizer) -> bool:
        split = tokenizer.pre_tokenizer
        return (
            tokenizer.normalizer is None
            and type(split).__name__ == "ByteLevel"
            and split.use_regex
            and not split.add_prefix_space
        )


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


SHARD = pa.schema(
    [
        ("part", pa.int64()), ("seq", pa.int64()), ("part_start", pa.int64()), ("n_ids", pa.int64()),
        ("n_docs", pa.int64()), ("first_key", pa.int64()), ("last_key", pa.int64()),
        ("width", pa.int32()), ("payload", pa.binary()), ("ends", pa.binary()), ("keys", pa.binary()),
        ("valid", pa.binary()), ("levels", pa.binary()), ("bits", pa.binary()),
        ("slots", pa.binary()), ("prints", pa.binary()),
    ]
)
SHARD_SQL = (
    "part bigint, seq bigint, part_start bigint, n_ids bigint, n_docs bigint, first_key bigint, "
    "last_key bigint, width int, payload binary, ends binary, keys binary, valid binary, "
    "levels binary, bits binary, slots binary, prints binary"
)


def shard_row(part: int, seq: int, start: int, keys: list, encoded: list[bytes], width: int) -> dict:
    ends = np.cumsum([len(e) // 4 for e in encoded], dtype=np.uint64)
    ids = np.frombuffer(b"".join(encoded), np.uint32).astype(f"<u{width}")
    valid = np.array([k is not None for k in keys], bool)
    values = np.array([0 if k is None else k for k in keys], "<i8")
    distinct, first, times = np.unique(values[valid], return_index=True, return_counts=True)
    index = MinimalHash.of(distinct)
    slots = index.slots(distinct)
    table = np.zeros((len(distinct), 2), "<u4")
    table[slots] = np.stack([first + (~valid).sum(), times], axis=1)
    prints = np.zeros(len(distinct), "<u4")
    prints[slots] = fingerprint(distinct)
    return {
        "part": part, "seq": seq, "part_start": start, "n_ids": int(ends[-1]), "n_docs": len(keys),
        "first_key": int(distinct[0]) if len(distinct) else None,
        "last_key": int(distinct[-1]) if len(distinct) else None,
        "width": width, "payload": ids.tobytes(), "ends": ends.astype("<u8").tobytes(),
        "keys": values.tobytes(), "valid": valid.tobytes(),
        "levels": index.sizes.astype("<i8").tobytes(), "bits": np.packbits(index.bits).tobytes(),
        "slots": table.tobytes(), "prints": prints.tobytes(),
    }


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_ids: int = SHARD_IDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode ``docs`` and write the shards to ``path``.

    Rows are dealt by ranges of (key, hash of the text), so a key that many rows share spreads over
    tasks and shards and its rows stay neighbours.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        coder = tokens(tokenizer)
        width = 2 if max(coder.size, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], np.uint32).tobytes()
        keys: list = []
        encoded: list[bytes] = []
        held = start = seq = 0

        def close():
            nonlocal keys, encoded, held, start, seq
            row = shard_row(part, seq, start, keys, encoded, width)
            start, seq = start + row["n_ids"], seq + 1
            keys, encoded, held = [], [], 0
            return pa.RecordBatch.from_pylist([row], SHARD)

        for ids, texts in rows_of(batches):
            for key, ids_of in zip(ids.to_pylist(), map(coder.encode, texts), strict=True):
                keys.append(key)
                encoded.append(ids_of + end)
                held += len(ids_of) // 4 + 1
                if held >= shard_ids:
                    yield close()
        if keys:
            yield close()

    rows = texts_of(docs, id_col, text_col)
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = dealt.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(run, SHARD_SQL).write.option("compression", "zstd").parquet(path)


def part_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """The ids before each range of keys: one row per write task goes through the driver."""
    rows = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    starts, total = {}, 0
    for part, n in sorted((r.part, r.n) for r in rows):
        starts[part] = total
        total += n
    return starts


class Shard:
    """One row of the table, opened."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["payload"], f"<u{row['width']}")
        self.ends = np.frombuffer(row["ends"], "<u8").astype(np.int64)
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.valid = np.frombuffer(row["valid"], bool)
        sizes = np.frombuffer(row["levels"], "<i8")
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum()))
        self.index = MinimalHash(sizes, bits.astype(bool))
        self.table = np.frombuffer(row["slots"], "<u4").reshape(-1, 2).astype(np.int64)
        self.prints = np.frombuffer(row["prints"], "<u4")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of each key; (-1, 0) where it is absent."""
        if not len(self.table):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        slots = self.index.slots(keys)
        hit = (slots >= 0) & (self.prints[slots] == fingerprint(keys))
        first, times = self.table[slots].T
        hit &= self.keys[np.where(hit, first, 0)] == keys
        return np.where(hit, first, -1), np.where(hit, times, 0)

    def span(self, doc: int) -> tuple[int, int]:
        return (int(self.ends[doc - 1]) if doc else 0), int(self.ends[doc])


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, read through the index: start, number and checksum of its ids."""
    starts = part_starts(spark, path)
    columns = ["part", "part_start", "width", "payload", "ends", "keys", "valid", "levels", "bits", "slots", "prints"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard = Shard(row)
                base = starts[row["part"]] + row["part_start"]
                keys = np.unique(shard.keys[shard.valid])
                firsts, times = shard.find(keys)
                places = [np.arange((~shard.valid).sum())]
                places += [np.arange(f, f + n) for f, n in zip(firsts.tolist(), times.tolist(), strict=True)]
                docs = np.concatenate(places).astype(np.int64)
                spans = [shard.span(d) for d in docs.tolist()]
                sums = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.keys[docs], pa.int64(), mask=~shard.valid[docs]),
                        pa.array([base + a for a, _ in spans], pa.int64()),
                        pa.array([b - a for a, b in spans], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.schema(SHARD_SQL).parquet(path).select(*columns)
    return shards.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def look_up(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """The ids of the documents with the given keys; shards without one of them are skipped unread."""
    wanted = np.unique(np.array(keys, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0])
                firsts, times = shard.find(wanted)
                rows = [
                    {"doc_id": int(k), "ids": shard.ids[slice(*shard.span(d))].astype(np.int64).tolist()}
                    for k, f, n in zip(wanted.tolist(), firsts.tolist(), times.tolist(), strict=True)
                    for d in range(f, f + n)
                ]
                yield pa.RecordBatch.from_pylist(
                    rows, pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
                )

    shards = spark.read.schema(SHARD_SQL).parquet(path)
    near = F.lit(False)
    for key in wanted.tolist():
        near = near | ((F.col("first_key") <= key) & (F.col("last_key") >= key))
    return shards.filter(near).mapInArrow(run, "doc_id bigint, ids array<bigint>")
