"""Document fingerprints by Order MinHash.

A text is the set of its k-mers of code points, each numbered by its occurrence, so that a
repeated k-mer counts as often as it occurs.  For each of ``M`` random orders of all numbered
k-mers the ``L`` smallest of the text are selected, kept in the order in which they stand in the
text, and hashed as a tuple.  The share of equal positions of two signatures estimates a
likeness that falls with the edit distance: moving passages about changes it, unlike MinHash.

Neighbours (``with_next``): documents are cut into parts along their order, many per task, so that
each text crosses the network once; only the first document of a part is sent twice, to its own
part and to the one before.  The number of parts grows with the size of the texts; the driver sees
one number for each, the first documents of the parts are a table.

Edge cases: a missing text is empty; an empty text has a fingerprint of its own; a text shorter
than k is one k-mer.  Rows of one id are ordered by a hash of their text; missing ids come last;
a table of one row is its own neighbour, an empty one gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import ship, shuffle_partitions, text_or_empty
from tidemark.session import durable

K, L, M = 6, 2, 32
SEED = 20_240_117
AT_ONCE = 1 << 15  # cells of the table of orders by k-mers that are held at a time
RANGES = 16  # parts per shuffle partition at least
PART_BYTES = 256 << 20  # text of a part at most, about

_draw = np.random.Generator(np.random.PCG64(SEED))
_TIMES = _draw.integers(0, 2**63, M, np.uint64) << np.uint64(1) | np.uint64(1)
_PLACE = _draw.integers(0, 2**63, K, np.uint64) << np.uint64(1) | np.uint64(1)
_TUPLE = _draw.integers(0, 2**63, L, np.uint64) << np.uint64(1) | np.uint64(1)
_MOST = np.uint64(2**64 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def numbered_kmers(points: np.ndarray) -> np.ndarray:
    """A hash of every (k-mer, occurrence number), in text order."""
    n = len(points)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(K, n)
    codes, own = points.astype(np.uint64) + np.uint64(1), np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        own += codes[i : n - k + 1 + i] * _PLACE[i]
    own = _mix(own)
    # Sort hashes with the position in their low bits: equal k-mers stand together in text order.
    low = np.uint64((1 << max(1, (len(own) - 1).bit_length())) - 1)
    sorted_ = np.sort((own & ~low) | np.arange(len(own), dtype=np.uint64))
    place, same = (sorted_ & low).astype(np.int64), sorted_ & ~low
    again = np.flatnonzero(same[1:] == same[:-1]) + 1
    if len(again):
        # Within a run of equal k-mers the number counts up from 1; a first occurrence has 0.
        starts = np.r_[True, np.diff(again) != 1]
        begin = again[starts][np.cumsum(starts) - 1]
        own[place[again]] += (again - begin + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mix(own)


def fingerprint(points: np.ndarray) -> np.ndarray:
    """``M`` 32-bit hashes for a text given as code points."""
    kmers = numbered_kmers(points)
    take = min(L, len(kmers))
    out = np.full(M, take, np.uint64)
    if not take:
        return out.astype(np.uint32)
    step = max(1, AT_ONCE // len(kmers))
    for m in range(0, M, step):
        # Hashed k-mers times an odd number: a fresh order of all of them for each multiplier.
        order = kmers[None, :] * _TIMES[m : m + step, None]
        rows, chosen = np.arange(len(order)), []
        for _ in range(take):
            chosen.append(order.argmin(axis=1))
            order[rows, chosen[-1]] = _MOST
        chosen = np.sort(np.stack(chosen), axis=0)  # text order
        for i in range(take):
            out[m : m + step] = _mix(out[m : m + step] + kmers[chosen[i]] * _TUPLE[i])
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def _cuts(rows: DataFrame, parts: int) -> list[float]:
    """Descending values of ``along`` that cut the rows into about equal parts."""
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("along", shares, 20 * parts)).first()[0] or []
    return sorted(set(found), reverse=True)


def _part_of(cuts: list[float]) -> Column:
    """How many of the cuts are greater than ``along``, by halving."""
    if not cuts:
        return F.lit(0)
    table, n = F.lit(cuts), len(cuts)

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        greater = F.get(table, middle) > F.col("along")
        open_ = at["low"] < at["high"]
        return F.struct(
            F.when(open_ & greater, middle + 1).otherwise(at["low"]).alias("low"),
            F.when(open_ & ~greater, middle).otherwise(at["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(0), F.lit(n.bit_length()))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(n).alias("high")), halve, lambda at: at["low"])


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (part, look, doc_id, text) sorted within partitions by descending id.

    A row with ``look`` true closes its part: it repeats the first row of the following part
    (after the last part: of the first), so each row's successor is the next row.

    Rows that share an id, or have none, are dealt by a hash of their text and copies by a number,
    so that the parts are even whatever the ids are.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    size, least = rows.agg(F.sum(F.octet_length("text") + 16), F.min("doc_id")).first()
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(0xFFFF))
    rows = rows.select(
        "*", F.col("doc_id").isNotNull().alias("has"), F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash"),
        place.alias("copy"),
    )
    # One number that falls along the order; a missing id counts 0, the least id 1.
    number = F.coalesce(F.col("doc_id").cast("double") - F.lit(float(least or 0)) + 1, F.lit(0.0))
    rows = rows.withColumn("along", number * 2.0**48 + F.col("hash") * 2.0**16 + F.col("copy"))
    parts = max(RANGES * shuffle_partitions(spark), (size or 0) // PART_BYTES)
    rows = rows.withColumn("part", _part_of(_cuts(rows, parts)))
    order = ("has", "doc_id", "hash", "copy")
    heads = durable(rows.groupBy("part").agg(F.max(F.struct(*order)).alias("head")))
    # The part before; the first one, which has none, follows the last.
    before = F.lag("part").over(Window.orderBy("part"))  # one row for each part
    last = heads.agg(F.max("part")).first()[0]
    looks = durable(heads.select("part", "head", F.coalesce(before, F.lit(last)).alias("before")))
    first = F.struct(*order) == F.col("head")
    rows = rows.join(looks, "part")
    own, look = F.struct("part", F.lit(False).alias("look")), F.struct(F.col("before").alias("part"), F.lit(True).alias("look"))
    places = F.when(first, F.array(own, look)).otherwise(F.array(own))
    rows = rows.select(F.explode(places).alias("to"), *order, "text").select("to.*", *order, "text")
    rows = rows.repartition(shuffle_partitions(spark), "part")
    return rows.sortWithinPartitions("part", "look", *map(F.desc, order)).select("part", "look", "doc_id", "text")


_PRINT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _edit_and_print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint of every text, of its edited text, and likeness to the successor."""
    held, closed = None, None  # held: part, id, text, points, signature of the row that awaits its successor
    for batch in batches:
        out = []
        for part, look, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "look", "doc_id", "text"))):
            if look and closed == part:
                continue
            points = points_of(text)
            signature = fingerprint(points)
            if held is not None:
                _, own_id, own, own_points, own_signature = held
                n = len(own)
                m = n // 2
                edited = fingerprint(np.r_[own_points[: n - m], points[:m]])
                sha = hashlib.sha256((own[: n - m] + text[:m]).encode()).hexdigest()
                out.append(
                    (own_id, n, sha, _hex(own_signature), _hex(edited), likeness(own_signature, edited), likeness(own_signature, signature))
                )
            closed, held = (part, None) if look else (None, (part, doc_id, text, points, signature))
        if out:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = [c.split()[0] for c in _PRINT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
    if held is not None:
        raise RuntimeError("a part ended without the row that follows it")


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of the texts and of edited texts whose later half comes from the next document."""
    ship(docs.sparkSession)
    return with_next(docs).mapInArrow(_edit_and_print, _PRINT)


def _print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [_hex(fingerprint(points_of(t))) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint): the ``M`` hashes of each text as hexadecimal digits, eight each."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(_print, "doc_id long, fingerprint string")
