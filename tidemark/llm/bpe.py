"""Byte-level BPE through a sentencepiece model that is serialised from the ranks.

The model holds one piece per vocabulary entry, in the order of the ranks: the entry's bytes, each
written as one printable character, scored by its negative rank. With identity normalisation, no
dummy prefix and no special treatment of spaces, sentencepiece merges the neighbours whose joined
piece has the highest score, the leftmost first, which is the rule of the rank files. Each match of
the splitting pattern is encoded for itself. Decoding is the inverse mapping of ids to bytes.

Null texts count as empty and have no ids; repeated rows are encoded each for itself; extra columns
are not looked at; texts are never cut short.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import rows_of, texts_of
from tidemark.llm.pretokens import MatchEncoder, byte_letters, spelled


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file, in the order of their ranks, which must have no gap."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    by_rank = {int(rank): base64.b64decode(entry) for entry, rank in pairs}
    if sorted(by_rank) != list(range(len(pairs))):
        raise ValueError("ranks have gaps or repeats")
    return [by_rank[i] for i in range(len(pairs))]


def serialised_model(entries: list[bytes]) -> bytes:
    """The sentencepiece model of a vocabulary; piece i has id i, one unknown piece follows."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    letters = byte_letters()
    model = proto.ModelProto()
    for rank, entry in enumerate(entries):
        model.pieces.add(piece="".join(letters[b] for b in entry), score=-float(rank), type=1)
    model.pieces.add(piece="<no piece>", score=0.0, type=2)
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(entries)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.trainer_spec.unk_piece = "<no piece>"
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class ByteBpe:
    """Encoder and decoder of one rank file; workers build it once, from the file they all have."""

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, pattern

    def __reduce__(self):
        return coder, (self.path, self.pattern)

    @cached_property
    def entries(self) -> list[bytes]:
        return read_ranks(self.path)

    @cached_property
    def whole(self) -> dict[bytes, int]:
        return {entry: i for i, entry in enumerate(self.entries)}

    @cached_property
    def model(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=serialised_model(self.entries))

    @cached_property
    def encoder(self) -> MatchEncoder:
        return MatchEncoder(self.pattern, self.encode_match)

    def encode_match(self, match: str) -> list[int]:
        """A match that is an entry of the vocabulary is its id, others are merged."""
        whole = self.whole.get(match.encode())
        return self.model.EncodeAsIds(spelled(match)) if whole is None else [whole]

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.encoder(text) for text in texts]

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        entries = self.entries
        return b"".join([entries[i] for i in ids])


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def list_of(encoded: list[bytes]) -> pa.Array:
    """Lists of 32-bit ids from their bytes, without a Python object per id."""
    ends = np.cumsum([0, *[len(e) // 4 for e in encoded]])
    values = np.frombuffer(b"".join(encoded), np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and its ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for ids, texts in rows_of(batches, 256):
            yield pa.RecordBatch.from_arrays([ids, list_of(bpe.encode(texts))], ["doc_id", "ids"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add ``decoded``, the bytes of the ids; other columns stay."""
    names = encoded.columns
    place = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                lists = piece.column(place)
                values = lists.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum([0, *[n or 0 for n in lists.value_lengths().to_pylist()]])
                texts = [bpe.decode(values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(texts, pa.binary())], [*names, "decoded"]
                )

    schema = encoded.drop("decoded").schema.add("decoded", "binary")
    return encoded.drop("decoded").mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and digests of ``decode(encode(...))``."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
