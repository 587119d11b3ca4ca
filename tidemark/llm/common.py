"""What several corpus operators share: word hashes, packed integers, code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The word of all contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Words that a worker remembers; beyond it the memory is emptied, which changes no result.
MEMO = 400_000


class WordHashes(dict):
    """A 64-bit hash of each word (bytes), remembered up to ``MEMO`` words."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_TURN = np.uint64(29)
_HALF = np.uint64(32)
_MIX = np.uint64(0x9FB21C651E98DF25)
_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64
)


def ngram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each window of ``width`` consecutive word hashes, in text order."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        part = words[i : len(words) - width + 1 + i] * _PLACES[i % 5]
        total = (total ^ part ^ (part >> _TURN)) * _MIX
    return total ^ (total >> _HALF)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit integers as a width, the first value and gaps of that many bytes."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    body = np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return bytes([width]) + int(values[0]).to_bytes(8, "little") + body.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    """Inverse of ``pack_sorted``."""
    if not data:
        return np.zeros(0, np.uint64)
    width, body = data[0], np.frombuffer(data, np.uint8, offset=9)
    wide = np.zeros((len(body) // width + 1, 8), np.uint8)
    wide[1:, :width] = body.reshape(-1, width)
    gaps = wide.view("<u8").ravel().astype(np.uint64)
    gaps[0] = int.from_bytes(data[1:9], "little")
    return np.cumsum(gaps, dtype=np.uint64)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 where the text is missing."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(*columns: str) -> Column:
    """16 bytes that stand for the values of ``columns``; missing and empty values differ."""
    texts = [F.col(c).cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.md5(F.concat(*marked).cast("binary")))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per session, as a user would with --py-files."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return spark
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, Path(package.name) / file.relative_to(package))
    context.addPyFile(archive)
    context._tidemark_shipped = True
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of documents; operators with Python code find this package on the executors."""
    return ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
