"""Sharding indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts form a group and go to one shard; shards get sizes as equal as
possible.  Differencing keeps partial partitions in a queue and repeatedly combines the two with
the largest spread, the largest parts of one with the smallest of the other, until one is left.

Scale: only groups of more than 1 / ``HEAVY`` of all bytes are dealt as such, at most ``HEAVY`` of
them by arithmetic.  All smaller groups are first gathered by hash into ``BUNDLES`` bundles.  So
the queue never holds more than HEAVY + BUNDLES parts, at any corpus size, and these numbers are
what the driver sees; no fingerprint, group or document does.

Slots: rows are counted per (shard, cell), cells being hashes of the row, and numbered within a
cell from its running total, so a shard, or a group with a third of all rows, is never numbered
in one task.

Edge cases: a missing text counts as empty, size 1, and shares its group with empty texts; rows
that repeat stay together and get slots of their own in arbitrary order; a missing id is placed
like any other; fewer groups than shards leave shards empty; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import text_or_empty
from tidemark.session import durable

SHARDS = 8
HEAVY, BUNDLES = 4096, 4096
CELLS = 4096


def difference(sizes: list[int], shards: int = SHARDS) -> list[int]:
    """The shard of each part, by multi-way differencing."""
    if not sizes:
        return []
    # A queue entry: minus spread, tie-breaker, loads from large to small, members per load.
    queue = []
    for i, size in enumerate(sizes):
        loads = [size] + [0] * (shards - 1)
        queue.append((-size, i, loads, [[i]] + [[] for _ in range(shards - 1)]))
    heapq.heapify(queue)
    number = len(sizes)
    while len(queue) > 1:
        _, _, a, own = heapq.heappop(queue)
        _, _, b, other = heapq.heappop(queue)
        joined = []
        for x, y, mine, theirs in zip(a, reversed(b), own, reversed(other)):
            big, small = (mine, theirs) if len(mine) >= len(theirs) else (theirs, mine)
            big.extend(small)
            joined.append((x + y, big))
        joined.sort(key=lambda part: -part[0])
        loads = [part[0] for part in joined]
        heapq.heappush(queue, (loads[-1] - loads[0], number, loads, [part[1] for part in joined]))
        number += 1
    out = [0] * len(sizes)
    for shard, members in enumerate(queue[0][3]):
        for i in members:
            out[i] = shard
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs``."""
    spark = docs.sparkSession
    text = text_or_empty()
    raw = text.cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.md5(raw).alias("group"),
    )
    rows = durable(rows)
    groups = durable(rows.groupBy("group").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    heavy = F.col("bytes") > total // HEAVY
    bundle = F.pmod(F.xxhash64("group"), F.lit(BUNDLES))
    light = groups.where(~heavy).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes"))
    # Heavy groups are told apart by their rank only; their number is below HEAVY.
    large = groups.where(heavy).withColumn("part", (F.row_number().over(Window.orderBy(F.desc("bytes"), "group")) - 1))
    large = durable(large.select("group", "bytes", "part"))
    few = large.select("part", "bytes").orderBy("part").collect()
    many = light.orderBy("bundle").collect()
    placed = difference([r["bytes"] for r in few] + [r["bytes"] for r in many], shards)
    of_heavy = spark.createDataFrame([(r["part"], s) for r, s in zip(few, placed)], "part int, shard int")
    of_bundle = [0] * BUNDLES
    for r, s in zip(many, placed[len(few) :]):
        of_bundle[r["bundle"]] = s
    own = large.join(F.broadcast(of_heavy), "part").select("group", "shard")  # HEAVY rows at most
    rows = rows.join(F.broadcast(own), "group", "left")
    rows = rows.withColumn("shard", F.coalesce("shard", F.get(F.lit(of_bundle), bundle.cast("int"))))
    return numbered(rows.select("doc_id", "size", "text_crc32", "shard"))


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each ``shard``, without gaps."""
    # The running number spreads rows that repeat, as those of one text without an id.
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = durable(rows.withColumn("cell", F.pmod(F.xxhash64("place"), F.lit(CELLS))))
    counts = rows.groupBy("shard", "cell").agg(F.count("*").alias("k"))
    earlier = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = durable(counts.select("shard", "cell", F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("offset")))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size", "place")
    rows = rows.withColumn("n", F.row_number().over(within) - 1)
    rows = rows.join(offsets, ["shard", "cell"])
    return rows.select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("n")).alias("slot"))
