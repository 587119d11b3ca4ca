"""Token ids in seekable zstandard files.

A file is a sequence of independent zstandard frames, each with the ids of some whole documents
(little-endian unsigned 32-bit integers), then a directory of the documents and a seek table,
both in skippable frames that ordinary decompressors pass over.  The seek table follows the
public seekable format: compressed size, decompressed size and checksum (the low 32 bits of
XXH64 of the content) of every frame.  A reader that wants some documents reads the end of the
file and decompresses only their frames, checking each.

Layout of the end: skippable frame 0x184D2A50 with the zstandard-compressed directory (one
record per document: flag for a missing id, id, number of ids), skippable frame 0x184D2A5E with
the seek table whose last nine bytes are the number of frames, a descriptor (checksums: 0x80)
and 0x8F92EAB1.

Plan: one range shuffle by document id puts the documents into files in ascending order; a task
writes one file under a name of its own attempt, and only the names returned by tasks that
succeeded enter the manifest, so lost or repeated tasks do no harm.  First ids of the files come
from a running total over the manifest, one row per file.

Edge cases: a missing or empty text has only the end id; a missing doc_id sorts first; rows of one
id are ordered by a hash of their text; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import io
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import public_tokenizers
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import ship, shuffle_partitions, text_or_empty
from tidemark.llm.pieces import BLANK, Pieces, slices
from tidemark.session import durable, work_path

VOCABULARY = "byte_bpe_50k.json"
END = 2
FRAME_IDS = 65_536  # a frame is closed after the document with which it has so many ids
DIRECTORY, SEEK, FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
# Spark's names of file systems and Arrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}
_RECORD = np.dtype([("missing", "u1"), ("doc_id", "<i8"), ("n", "<u4")])


class Writer:
    """Writes one seekable file to an open binary stream."""

    def __init__(self, out, frame_ids: int = FRAME_IDS) -> None:
        self.out, self.frame_ids = out, frame_ids
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.records, self.seek, self.held, self.size, self.total = [], [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.records.append((doc_id is None, doc_id or 0, n))
        self.held.append(ids)
        self.size += n
        self.total += n
        if self.size >= self.frame_ids:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            raw = b"".join(self.held)
            frame = self.packer.compress(raw)
            self.out.write(frame)
            self.seek.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.held, self.size = [], 0

    def close(self) -> None:
        self._flush()
        directory = self.packer.compress(np.array(self.records, _RECORD).tobytes())
        table = b"".join(self.seek) + struct.pack("<IBI", len(self.seek), 0x80, FOOTER)
        self.out.write(struct.pack("<II", DIRECTORY, len(directory)) + directory)
        self.out.write(struct.pack("<II", SEEK, len(table)) + table)


class Reader:
    """Reads documents of one seekable file; only the frames that hold them are decompressed."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size() if callable(getattr(source, "size", None)) else source.seek(0, io.SEEK_END)
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER or flags != 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        length = 12 * frames + 9
        self.frames = np.frombuffer(self._at(size - length, length - 9), "<u4").reshape(-1, 3)
        self.begin = np.r_[0, np.cumsum(self.frames[:, 0], dtype=np.int64)]
        at = int(self.begin[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != DIRECTORY:
            raise ValueError("no directory after the frames")
        unpacker = zstandard.ZstdDecompressor()
        self.records = np.frombuffer(unpacker.decompress(self._at(at + 8, length)), _RECORD)
        self.starts = np.r_[0, np.cumsum(self.records["n"], dtype=np.int64)]
        self.frame_starts = np.r_[0, np.cumsum(self.frames[:, 1], dtype=np.int64)] // 4
        self.last = (None, b"")

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, i: int) -> bytes:
        """The content of frame ``i``, checked."""
        if self.last[0] != i:
            packed, size, check = self.frames[i].tolist()
            raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.begin[i]), packed), max_output_size=size)
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {i} is damaged")
            self.last = (i, raw)
        return self.last[1]

    def document(self, k: int) -> tuple[int | None, int, bytes]:
        """(doc_id, ids before it in the file, its ids) of the ``k``-th document."""
        missing, doc_id, n = self.records[k].tolist()
        start = int(self.starts[k])
        i = int(np.searchsorted(self.frame_starts, start, "right")) - 1
        offset = 4 * (start - int(self.frame_starts[i]))
        return (None if missing else doc_id), start, self.frame(i)[offset : offset + 4 * n]

    def find(self, doc_ids: list[int]) -> list[int]:
        """Positions of the documents with these ids."""
        return np.flatnonzero(np.isin(self.records["doc_id"], doc_ids) & (self.records["missing"] == 0)).tolist()


# Pieces that can stand one after the other without touching: a space before and no white space at the end.
_APART = re.compile(f" [^{BLANK}](?:.*[^{BLANK}])?", re.DOTALL)
REMEMBERED = 192 << 20  # bytes of pieces and ids that a worker keeps from task to task; the library is slow on new ones
_JOINED = 1_000  # pieces encoded as one text


class Encoder:
    """Ids of pieces.  An encoding costs the library more than its words, so pieces are encoded many at a
    time as one text and told apart by the bytes that each id stands for."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)  # the name of an added token in a text becomes its one id
        names = self.model.get_vocab()
        self.sizes = np.zeros(max(names.values()) + 1, np.int64)
        self.sizes[list(names.values())] = [len(name) for name in names]  # byte level: a character for each byte

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list:
        apart = [i for i, t in enumerate(texts) if _APART.fullmatch(t)]
        groups = [apart[i : i + _JOINED] for i in range(0, len(apart), _JOINED)]
        out: list = [None] * len(texts)
        for group, ids in zip(groups, self._each(["".join([texts[i] for i in g]) for g in groups])):
            ids = np.array(ids, np.int32)
            ends = np.cumsum(self.sizes[ids])
            wanted = np.cumsum([len(texts[i].encode()) for i in group])
            at = np.searchsorted(ends, wanted)
            if len(ends) and ends[-1] == wanted[-1] and np.array_equal(ends[at], wanted):
                for i, a, b in zip(group, np.r_[0, at[:-1] + 1].tolist(), (at + 1).tolist()):
                    out[i] = ids[a:b]
        left = [i for i, found in enumerate(out) if found is None]
        for i, ids in zip(left, self._each([texts[i] for i in left])):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(None, Encoder(path), REMEMBERED)


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a folder or file that Spark names; object stores have other names there."""
    scheme, found, rest = uri.partition("://")
    return pyarrow.fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + found + rest if found else uri)


_FILES = "part int, path string, n_docs long, n_ids long"
_ENDING = int(END).to_bytes(4, "little")


def write(docs: DataFrame, folder: str | None = None, path: str | None = None, files: int | None = None) -> DataFrame:
    """Write the ids of ``docs`` and return the manifest: one row per file, ``first_id`` ids before it."""
    spark = ship(docs.sparkSession)
    folder, path = folder or work_path(spark, "tokens"), path or public_tokenizers.path(VOCABULARY)
    _file_system(folder)  # a store that Arrow does not know fails before the work starts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        task, pieces, writer, n = TaskContext.get(), _pieces(path), None, 0
        for batch in batches:
            if writer is None and batch.num_rows:
                system, root = _file_system(folder)
                system.create_dir(root, recursive=True)
                name = f"{root}/part-{task.partitionId():05d}-{task.taskAttemptId()}.ids.zst"
                out = system.open_output_stream(name, compression=None)
                writer = Writer(out)
            for part, texts in slices(batch, 1):
                for doc_id, coded in zip(part.column(0).to_pylist(), pieces.ids(texts)):
                    writer.add(doc_id, coded + _ENDING)
            n += batch.num_rows
        if writer is not None:
            writer.close()
            out.close()
            uri = folder.rstrip("/") + "/" + name.rsplit("/", 1)[1]
            columns = [[task.partitionId()], [uri], [n], [writer.total]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "path", "n_docs", "n_ids"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    # Many rows may lack an id or share one: the text's hash and a running number deal those, too.
    order = (F.asc_nulls_first("doc_id"), F.asc("hash"), F.asc("place"))
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"))
    rows = rows.repartitionByRange(files or shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    rows = rows.select("doc_id", "text")
    manifest = durable(rows.mapInArrow(run, _FILES))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return durable(manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long"))))


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the files; ``ids`` as they are stored."""
    spark = ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = _file_system(row["path"])
                with system.open_input_file(name) as source:
                    reader = Reader(source)
                    for k in range(0, len(reader.records), 2_000):
                        some = [reader.document(i) for i in range(k, min(k + 2_000, len(reader.records)))]
                        ids, starts, raw = zip(*some)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids, pa.int64()),
                                pa.array([row["first_id"] + s for s in starts], pa.int64()),
                                pa.array([len(r) // 4 for r in raw], pa.int64()),
                                pa.array(raw, pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )

    files = manifest.select("part", "path", "first_id").repartition(shuffle_partitions(spark), "part")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
