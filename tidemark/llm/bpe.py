"""Byte-level BPE through a sentencepiece model built from the vocabulary.

No merges are learned.  The model is serialised from a file of ranks: one piece per token, its
bytes written as the printable characters of byte-level BPE, with the negative rank as score,
so that sentencepiece merges the same pairs in the same order; normalisation is the identity.
Pre-tokens are encoded one by one and decoding maps ids back to pieces and pieces to bytes.

Every row is encoded where it is read: no shuffle, no key, and memory bounded by a batch.

Edge cases: a missing or empty text has no ids; every byte sequence can be encoded, so nothing
becomes unknown; repeated rows are encoded alike; an empty table gives no rows; columns named
for passing on are kept as they are.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tidemark.llm.common import ship
from tidemark.llm.pieces import Pieces, gather, slices

VOCABULARY = "byte_bpe_50k.tiktoken"


def byte_characters() -> list[str]:
    """The printable character for each byte: itself where printable, else the next from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model with one piece per token, and an unknown piece after them."""
    characters = byte_characters()
    model = proto.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece="".join(characters[b] for b in token), score=-float(rank))
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    train, normal = model.trainer_spec, model.normalizer_spec
    train.model_type, train.vocab_size = proto.TrainerSpec.BPE, len(model.pieces)
    train.unk_id, train.bos_id, train.eos_id, train.pad_id = len(tokens), -1, -1, -1
    normal.name = "identity"
    normal.add_dummy_prefix = normal.remove_extra_whitespaces = normal.escape_whitespaces = False
    return model.SerializeToString()


class Coder:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, path: str, pattern: str) -> None:
        self.tokens = read_ranks(path)
        self.ranks = {t: i for i, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.pattern = regex.compile(pattern)
        self.table = dict(enumerate(byte_characters()))
        self.pieces = Pieces(self.pattern.findall, self._encode)

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        raw = [p.encode() for p in pieces]
        # A pre-token that is itself a token needs no merges.
        rest = [p for p in raw if p not in self.ranks]
        mapped = [p.decode("latin-1").translate(self.table) for p in rest]
        known = dict(zip(rest, self.model.encode(mapped, num_threads=1))) if rest else {}
        return [known[p] if p in known else [self.ranks[p]] for p in raw]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        return self.pieces.ids(texts)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def _coded(batches: Iterator[pa.RecordBatch], column: int, path: str, pattern: str) -> Iterator[tuple[list[pa.Array], pa.Array]]:
    """The other columns and the ids of some rows at a time."""
    own = coder(path, pattern)
    with own.pieces.task():
        for batch in batches:
            for part, texts in slices(batch, column):
                coded = own.encode(texts)
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                yield part.columns[:column], ids


def _decoded(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy().astype(np.int64)
    return pa.array(gather(tokens, ids.flatten(), np.cumsum(np.r_[0, counts])), pa.binary())


def _named(docs: DataFrame, keep: tuple, *more: str) -> tuple[DataFrame, list[str], str]:
    """The kept columns under names of our own, those names, and their schema."""
    names = [f"__{i}" for i in range(len(keep))]
    frame = docs.select(*(F.col(c).alias(n) for n, c in zip(names, keep)), *more)
    return frame, names, "".join(f"{n} {frame.schema[n].dataType.simpleString()}, " for n in names)


def _back(frame: DataFrame, names: list[str], keep: tuple, *more: str) -> DataFrame:
    return frame.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), *more)


def encode(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", keep: tuple = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``ids``, the token ids of ``text``, as array<int>."""
    ship(docs.sparkSession)
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    frame, names, kinds = _named(docs, keep, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, ids in _coded(batches, len(names), path, pattern):
            yield pa.RecordBatch.from_arrays([*kept, ids], names=[*names, "ids"])

    return _back(frame.mapInArrow(run, f"{kinds}ids array<int>"), names, keep, "ids")


def decode(coded: DataFrame, path: str | None = None, keep: tuple = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``coded`` and ``decoded``, the bytes that ``ids`` stand for; none for missing ids."""
    ship(coded.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    frame, names, kinds = _named(coded, keep, F.col("ids").alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(read_ranks(path), pa.large_binary())
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                raw = _decoded(part.column(len(names)), tokens)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], raw], names=[*names, "decoded"])

    return _back(frame.mapInArrow(run, f"{kinds}decoded binary"), names, keep, "decoded")


def round_trip(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", keep: tuple = ("doc_id",)
) -> DataFrame:
    """``encode`` and ``decode`` in one pass, which needs one Python worker a task: ``keep``, ``ids`` and ``decoded``."""
    ship(docs.sparkSession)
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    frame, names, kinds = _named(docs, keep, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(read_ranks(path), pa.large_binary())
        for kept, ids in _coded(batches, len(names), path, pattern):
            yield pa.RecordBatch.from_arrays([*kept, ids, _decoded(ids, tokens)], names=[*names, "ids", "decoded"])

    return _back(frame.mapInArrow(run, f"{kinds}ids array<int>, decoded binary"), names, keep, "ids", "decoded")
