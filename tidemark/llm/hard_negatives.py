"""Hard negatives by a vertical scan (BOND) of integer vectors.

Rows are dealt into blocks.  Within a block the vectors stand column by column, rows of one label
side by side.  An anchor reads the columns in descending magnitude of its own components and keeps
a partial inner product of every row that is still alive; what the unread columns can add lies
between two numbers known from the least and greatest value of each column.  Rows that these
bounds exclude are cleared from the bitmap of candidates, until the rest is exact.

Two scans are needed, as the windows of the negatives hang on the scores of the positives:

1. of the rows with the anchor's label, the ``POSITIVES`` with the highest scores;
2. of the rows with another label, for each positive the ``NEGATIVES`` with the highest scores
   between ``LOW`` and ``HIGH`` hundredths of the positive's score.

Every block answers for itself with at most that many rows, and the answers of all blocks are
ranked per anchor.  The anchors are a stated query set: each block meets all of them, streamed in
Arrow batches after the rows of the block; a task holds one block and one batch of anchors.
Blocks are dealt by a running number and not by label, so that a label with a third of all rows
is spread over all blocks.

Edge cases: a row without a label or vector, or with a missing, infinite or NaN component takes no
part, nor does one with a component beyond 2 ** 18, whose products would not fit 64 bits.  Rows
compare only with rows of the same number of components.  A row without an id is no anchor, and
comes last among equal scores.  Rows that repeat are rows of their own: each is an anchor, and a
positive of the other.  An anchor without positives has no rows; an empty table gives none; other
columns are not touched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import ship, shuffle_partitions
from tidemark.session import durable

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # hundredths of a positive's score
SCALE = 256
LARGEST = 2.0**18
BLOCK_ROWS = 65_536  # rows of a block at most, about; there are as many blocks as shuffle partitions at least
STRIDE = 8  # columns read between two looks at the bounds

_POSITIVE = "anchor_row long, anchor_id long, id long, score long"
_NEGATIVE = "anchor_row long, anchor_id long, window long, id long, score long"


def integers(rows: DataFrame, id_: str, vector: str, label: Column, anchor: Column) -> DataFrame:
    """(row, anchor, id, label, vector): the rows that take part, with whole components."""
    value = F.col(vector).cast("array<double>")
    # NaN compares as the greatest value, so one comparison excludes it and both infinities.
    fits = F.forall(value, lambda x: F.coalesce((x <= LARGEST) & (x >= -LARGEST), F.lit(False)))
    whole = F.transform(value, lambda x: F.floor(x * SCALE)).cast("array<int>")
    return rows.where(F.col(vector).isNotNull() & fits & label.isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(id_).cast("long").alias("id"), label.cast("int").alias("label"), whole.alias("vector"),
    )


class Block:
    """Vectors of one length, column by column, rows of one label side by side."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, known: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.row, self.ids, self.known, self.labels = row[order], ids[order], known[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T.astype(np.int64))
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def same(self, label: int, row: int) -> np.ndarray:
        first, last = np.searchsorted(self.labels, [label, label + 1])
        return np.arange(first, last)[self.row[first:last] != row]

    def other(self, label: int) -> np.ndarray:
        first, last = np.searchsorted(self.labels, [label, label + 1])
        return np.r_[0:first, last : len(self.labels)]

    def scan(self, vector: np.ndarray, alive: np.ndarray, still: Callable) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of those of ``alive`` that ``still(lower, upper)`` never excluded."""
        order = np.argsort(-np.abs(vector), kind="stable")
        ends = np.sort([vector * self.least, vector * self.most], axis=0)[:, order]
        # What the columns from each place on can add at least and at most.
        rest = np.concatenate([np.cumsum(ends[:, ::-1], axis=1)[:, ::-1], np.zeros((2, 1), np.int64)], axis=1)
        score = np.zeros(len(alive), np.int64)
        for start in range(0, len(order), STRIDE):
            if not len(alive):
                break
            read = order[start : start + STRIDE]
            score = score + vector[read] @ self.columns[np.ix_(read, alive)]
            low, high = rest[:, min(start + STRIDE, len(order))]
            keep = still(score + low, score + high)
            if not keep.all():
                alive, score = alive[keep], score[keep]
        return alive, score

    def first(self, alive: np.ndarray, score: np.ndarray, most: int) -> list[tuple]:
        """(id or None, score) of the rows in front: higher scores, then smaller ids, missing ones last."""
        if len(score) > 4 * most:  # what lies below the last possible score need not be sorted
            front = score >= np.partition(score, -most)[-most]
            alive, score = alive[front], score[front]
        order = np.lexsort((self.ids[alive], ~self.known[alive], -score))[:most]
        return [(int(self.ids[i]) if self.known[i] else None, int(s)) for i, s in zip(alive[order], score[order])]


def nearest(block: Block, row: int, label: int, vector: np.ndarray) -> list[tuple]:
    """(id, score) of the rows of the same label with the highest scores."""

    def still(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= POSITIVES:
            return np.ones(len(lower), bool)
        return upper >= np.partition(lower, -POSITIVES)[-POSITIVES]

    return block.first(*block.scan(vector, block.same(label, row), still), POSITIVES)


def in_windows(block: Block, label: int, vector: np.ndarray, positives: list[int]) -> list[tuple]:
    """(positive's score, id, score) of the first rows of other labels in each window."""
    # 100 * score >= LOW * positive, in whole numbers; empty for a negative positive's score.
    windows = [(p, -(-LOW * p // 100), HIGH * p // 100) for p in sorted(set(positives))]
    windows = [w for w in windows if w[1] <= w[2]]
    if not windows:
        return []

    def still(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(lower), bool)
        for _, low, high in windows:
            inside = lower[(lower >= low) & (upper <= high)]
            # So many rows are surely inside: what stays below them is not among the first.
            least = np.partition(inside, -NEGATIVES)[-NEGATIVES] if len(inside) >= NEGATIVES else low
            keep |= (upper >= least) & (lower <= high)
        return keep

    alive, score = block.scan(vector, block.other(label), still)
    out = []
    for p, low, high in windows:
        inside = (score >= low) & (score <= high)
        out += [(p, *found) for found in block.first(alive[inside], score[inside], NEGATIVES)]
    return out


def _vectors(column: pa.ListArray, length: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), length)


def _scanned(task: Iterator[pa.RecordBatch], answer: Callable) -> Iterator[tuple]:
    """``answer(block, anchor fields)`` for every block of a task and every anchor that follows its rows.

    Batches are ordered by block and length, rows before anchors; a block is gathered until its first anchor.
    """
    now, gathered, block = None, [], None
    for batch in task:
        keys = np.stack([batch.column(c).to_numpy() for c in ("block", "length", "side")], axis=1)
        cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(keys)]):
            part, (key, length, side) = batch.slice(a, b - a), keys[a]
            if (key, length) != now:
                now, gathered, block = (key, length), [], None
            vectors = _vectors(part.column("vector"), length)
            ids = part.column("id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            fields = [part.column("row").to_numpy(), ids.fill_null(0).to_numpy(), known, part.column("label").to_numpy()]
            if side == 0:
                gathered.append([*(f.copy() for f in fields), vectors.copy()])
                continue
            if block is None and gathered:
                block, gathered = Block(*map(np.concatenate, zip(*gathered))), []
            if block is not None:
                windows = part.column("positives").to_pylist()
                for row, id_, label, vector, positives in zip(fields[0].tolist(), fields[1].tolist(), fields[3].tolist(), vectors, windows):
                    yield from ((row, id_, *x) for x in answer(block, row, label, vector.astype(np.int64), positives))


def _answers(streams: DataFrame, answer: Callable, schema: str) -> DataFrame:
    kinds = [part.split() for part in schema.split(", ")]
    arrow = pa.schema([(name, pa.int64()) for name, _ in kinds])

    def run(task: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in _scanned(task, answer):
            held.append(row)
            if len(held) == 20_000:
                yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in held], schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in held], schema=arrow)

    return streams.mapInArrow(run, schema)


def _streams(spark: SparkSession, rows: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Rows of each block followed by all anchors, block by block and length by length."""
    length = F.size("vector").alias("length")
    none = F.lit(None).cast("array<long>").alias("positives")
    place = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block")
    own = rows.select(place, length, F.lit(0).alias("side"), "row", "id", "label", "vector", none)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asked = anchors.select(every, length, F.lit(1).alias("side"), "row", "id", "label", "vector", "positives")
    return own.unionByName(asked).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "length", "side")


def mine(
    rows: DataFrame, *, label: Column, anchor: Column, id_: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """For each anchor and positive the first negatives of its window:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = ship(rows.sparkSession)
    # Written once, so that the running numbers stay the same when an executor is lost.
    own = durable(integers(rows, id_, vector, label, anchor))
    blocks = max(shuffle_partitions(spark), -(-own.count() // BLOCK_ROWS))
    anchors = own.where("anchor and id is not null")
    none = F.lit(None).cast("array<long>")

    def positives_of(block: Block, row: int, label: int, vector: np.ndarray, _: object) -> list[tuple]:
        return nearest(block, row, label, vector)

    found = _answers(_streams(spark, own, anchors.withColumn("positives", none), blocks), positives_of, _POSITIVE)
    order = (F.col("score").desc(), F.col("id").asc_nulls_last())
    place = F.row_number().over(Window.partitionBy("anchor_row").orderBy(*order))
    positives = durable(found.withColumn("place", place).where(F.col("place") <= POSITIVES))

    scores = positives.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set("score").alias("positives"))
    asked = anchors.join(scores, "row")

    def negatives_of(block: Block, row: int, label: int, vector: np.ndarray, positives: list[int]) -> list[tuple]:
        return in_windows(block, label, vector, positives)

    found = _answers(_streams(spark, own, asked, blocks), negatives_of, _NEGATIVE)
    place = F.row_number().over(Window.partitionBy("anchor_row", "window").orderBy(*order))
    negatives = found.withColumn("rank", place).where(F.col("rank") <= NEGATIVES)
    p, n = positives.alias("p"), negatives.alias("n")
    joined = p.join(n, (F.col("p.anchor_row") == F.col("n.anchor_row")) & (F.col("p.score") == F.col("n.window")))
    return joined.select(
        F.col("p.anchor_id"), F.col("p.id").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"), F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )
