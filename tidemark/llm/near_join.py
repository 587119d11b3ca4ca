"""N-gram Jaccard join: documents whose word shingle sets are alike, grouped by links.

Rare-first prefix filtering.  The shingles of a document are ordered by the number of
documents that have them, rarest first.  If two sets reach the threshold, their prefixes of
``n - ceil(threshold * n) + 1`` shingles meet.  A shingle that only one document has can meet
nothing, so a document with that many of those is settled at once, and only the others enter
the index.  There, length, positional and suffix filters discard pairs, and what is left is
verified once per pair on whole sets.

Cost.  Frequencies need every shingle of every document to move once.  The shingles of a
block of documents travel sorted and gap-coded, one row per (block, hash range): about 6
bytes each instead of some 15 as rows.  Only shingles that two documents share travel back.

Candidates form clusters: classes (documents with equal sets are one class) that share a
prefix shingle, directly or through others.  A cluster of up to ``CLUSTER`` classes is resolved in
one task, which holds its sets and an inverted index.  Larger clusters, without limit, are
resolved by joins: within a posting list, members are first compared with one hub; members already
known to be connected are not compared again, so a group of near copies costs about one
comparison each; lists that still hold several components are then compared exhaustively across
components.  Either way no pair of different components is left out.

Shingles are told apart by 48-bit hashes: two of one document fall together with a chance of about
``n * n / 2 ** 49``, one in a million for 20,000 shingles, and sizes count hashes.

Hot keys.  A shingle that many documents of a block have leaves the block as one count; the
documents that have it stay with the block.  Everything else is aggregated or joined.

Edge cases: a missing text, or one without words, has no shingles and links with nothing; a
text of fewer words than ``width`` is one shingle, the whole sequence.  Rows that repeat, or
differ only in the id, are one class.  A missing id takes part; its component is the smallest
id reachable, NULL if there is none.  Other columns are not touched.  An empty table gives no rows.

Rows must come in a repeatable order, as from a table scan, so that a task run again after a
lost executor forms the same blocks; write any other input to a table first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import WordHashes, ngram_hashes, pack_sorted, ship, unpack_sorted
from tidemark.session import durable, release

WIDTH, THRESHOLD = 5, (75, 100)
BLOCK_SHINGLES, BLOCK_DOCS = 2_000_000, 60_000
RANGE_SHINGLES = 1_000_000  # shingles per hash range, about; one task holds one range
HOT = 64  # members of one shingle within a block, from which only their count leaves it
DF_MAX = 65_535  # order classes of document frequency end here
CLUSTER, CLUSTER_SHINGLES = 5_000, 4_000_000  # classes and shingles that one task may resolve
SHINGLE_BYTES = 6
SHAPE = 16  # parts of the hash space that the suffix filter counts
HUB_ROUNDS = 8
LIST_BLOCK = 1_000  # members of a posting list that meet in one key, about

_FACTS, _SHINGLES, _MEMBERS, _SHARED = 0, 1, 2, 3
_MESSAGE = "key long, block long, kind int, a binary, b binary, c binary, d binary"
_ARROW = pa.schema(
    [("key", pa.int64()), ("block", pa.int64()), ("kind", pa.int32())] + [(c, pa.binary()) for c in "abcd"]
)
_LOW48 = np.uint64(16)


def shingles(words: list[bytes], memo: WordHashes, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a document as ascending 48-bit hashes."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\n".join(words)) >> 16], np.uint64)
    return np.unique(ngram_hashes(memo.of(words), width) >> _LOW48)


def packed(hashes: np.ndarray) -> bytes:
    """48-bit hashes in any order as six bytes each."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHINGLE_BYTES]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """Inverse of ``packed``."""
    wide = np.zeros((len(data) // SHINGLE_BYTES, 8), np.uint8)
    wide[:, :SHINGLE_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SHINGLE_BYTES)
    return wide.view("<u8").ravel().astype(np.uint64)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW)], schema=_ARROW)


def _block(
    number: int, ids: list, sets: list[np.ndarray], keys: list[bytes], ranges: int, marks: list[bytes] | None = None
) -> pa.RecordBatch:
    """The messages of one block: its documents, its shingles by hash range, its hot members.

    ``marks`` are 16 bytes for each document that come back with it.
    """
    first: dict[bytes, int] = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    own = list(first.values())  # equal sets speak once
    hashes = np.concatenate([sets[i] for i in own] or [np.zeros(0, np.uint64)])
    members = np.repeat(np.array(own, np.uint16), [len(sets[i]) for i in own])
    order = np.argsort(hashes, kind="stable")
    hashes, members = hashes[order], members[order]
    distinct, begin, count = np.unique(hashes, return_index=True, return_counts=True)
    hot = count > HOT
    is_hot = np.repeat(hot, count)
    numbers = np.array([0 if i is None else i for i in ids], np.int64)
    missing = np.array([i is None for i in ids], np.uint8)
    sizes = np.array([len(s) for s in sets], np.uint32)
    # A key of its own for every block: what stays with the block meets no other block.
    rows = [(-1 - number, number, _FACTS, numbers.tobytes(), missing.tobytes() + b"".join(marks or []), sizes.tobytes(), b"".join(keys))]
    if hot.any():
        rows.append(
            (-1 - number, number, _MEMBERS, pack_sorted(distinct[hot]), count[hot].astype("<u4").tobytes(),
             members[is_hot].tobytes(), b"")
        )

    def cut(values: np.ndarray) -> np.ndarray:
        part = ((values >> np.uint64(16)) * np.uint64(ranges)) >> np.uint64(32)
        return np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))

    plain, plain_members = hashes[~is_hot], members[~is_hot]
    hot_hashes, hot_counts = distinct[hot], count[hot].astype("<u4")
    at, hot_at = cut(plain), cut(hot_hashes)
    for r in range(ranges):
        s, h = slice(at[r], at[r + 1]), slice(hot_at[r], hot_at[r + 1])
        if s.stop > s.start or h.stop > h.start:
            rows.append(
                (r, number, _SHINGLES, pack_sorted(plain[s]), plain_members[s].tobytes(), pack_sorted(hot_hashes[h]),
                 hot_counts[h].tobytes())
            )
    return _batch(rows)


def _speak(batches: Iterator[pa.RecordBatch], width: int, ranges: int) -> Iterator[pa.RecordBatch]:
    memo, number = WordHashes(), TaskContext.get().partitionId() << 32
    ids, sets, keys, marks, held = [], [], [], [], 0
    for batch in batches:
        extra = batch.column(2).to_pylist() if batch.num_columns > 2 else [b""] * batch.num_rows
        for i, text, mark in zip(batch.column(0).to_pylist(), batch.column(1), extra):
            raw = text.as_py()
            marks.append(mark)
            found = shingles(raw.encode().lower().split() if raw else [], memo, width)
            ids.append(i)
            sets.append(found)
            keys.append(xxhash.xxh3_128_digest(found.tobytes()))
            held += len(found)
            if held >= BLOCK_SHINGLES or len(ids) >= BLOCK_DOCS:
                yield _block(number, ids, sets, keys, ranges, marks)
                ids, sets, keys, marks, held, number = [], [], [], [], 0, number + 1
    if ids:
        yield _block(number, ids, sets, keys, ranges, marks)


def _count(table: pa.Table) -> pa.Table:
    """Document frequencies of one hash range; returns to each block what others have as well."""
    if table["key"][0].as_py() < 0:
        return table
    rows = table.to_pylist()
    hashes, members, counts, row = [], [], [], []
    for i, r in enumerate(rows):
        plain, hot = unpack_sorted(r["a"]), unpack_sorted(r["c"])
        hashes += [plain, hot]
        members += [np.frombuffer(r["b"], np.uint16), np.full(len(hot), 0xFFFF, np.uint16)]
        counts += [np.ones(len(plain), np.uint32), np.frombuffer(r["d"], "<u4")]
        row.append(np.full(len(plain) + len(hot), i, np.uint32))
    hashes, members, counts, row = map(np.concatenate, (hashes, members, counts, row))
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    begin = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts[order].astype(np.uint64), begin) if len(hashes) else np.zeros(0, np.uint64)
    df = np.repeat(np.minimum(total, DF_MAX), np.diff(np.r_[begin, len(hashes)])).astype(np.uint16)
    shared = df > 1
    order, hashes, df = order[shared], hashes[shared], df[shared]
    by_row = np.argsort(row[order], kind="stable")
    order, hashes, df = order[by_row], hashes[by_row], df[by_row]
    at = np.searchsorted(row[order], np.arange(len(rows) + 1))
    out = [
        (r["key"], r["block"], _SHARED, pack_sorted(hashes[s]), df[s].tobytes(), members[order[s]].tobytes(), b"")
        for i, r in enumerate(rows)
        if (s := slice(at[i], at[i + 1])).stop > s.start
    ]
    return pa.Table.from_batches([_batch(out)]) if out else _ARROW.empty_table()


_FACT_ROWS = "doc_id long, n long, key binary, lone long, shared binary, mark binary"
_FACT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("lone", pa.int64()), ("shared", pa.binary())]
    + [("mark", pa.binary())]
)


def _hear(table: pa.Table, num: int, den: int) -> pa.Table:
    """The documents of a block; those that may link carry their shared shingles, rare first."""
    hashes, frequency, members, hot = [], [], [], None
    for r in table.to_pylist():
        if r["kind"] == _FACTS:
            ids = np.frombuffer(r["a"], np.int64)
            missing, sizes = np.frombuffer(r["b"], np.uint8, len(ids)), np.frombuffer(r["c"], np.uint32)
            marks = [r["b"][i : i + 16] for i in range(len(ids), len(r["b"]), 16)] or [None] * len(ids)
            keys = [r["d"][i : i + 16] for i in range(0, len(r["d"]), 16)]
        elif r["kind"] == _MEMBERS:
            hot = unpack_sorted(r["a"]), np.frombuffer(r["b"], "<u4"), np.frombuffer(r["c"], np.uint16)
        else:
            hashes.append(unpack_sorted(r["a"]))
            frequency.append(np.frombuffer(r["b"], np.uint16))
            members.append(np.frombuffer(r["c"], np.uint16))
    lists: dict[int, bytes] = {}
    lone = sizes.astype(np.int64).copy()
    if hashes:
        hashes, frequency, members = map(np.concatenate, (hashes, frequency, members))
        if hot is not None:
            mark = members == 0xFFFF
            order = np.argsort(hashes[mark])
            df = frequency[mark][order][np.searchsorted(hashes[mark][order], hot[0])]
            hashes = np.r_[hashes[~mark], np.repeat(hot[0], hot[1])]
            frequency = np.r_[frequency[~mark], np.repeat(df, hot[1])]
            members = np.r_[members[~mark], hot[2]]
        order = np.lexsort((hashes, frequency, members))
        hashes, members = hashes[order], members[order]
        at = np.searchsorted(members, np.arange(len(sizes) + 1))
        for i in np.unique(members).tolist():
            n, m = int(sizes[i]), int(at[i + 1] - at[i])
            lone[i] = n - m
            if n - m < n - -(-num * n // den) + 1:
                lists[i] = packed(hashes[at[i] : at[i + 1]])
    return pa.table(
        [
            pa.array(ids, mask=missing.astype(bool)),
            pa.array(sizes.astype(np.int64)),
            pa.array(keys, pa.binary()),
            pa.array(lone),
            pa.array([lists.get(i) for i in range(len(sizes))], pa.binary()),
            pa.array(marks, pa.binary()),
        ],
        schema=_FACT_ARROW,
    )


_POSTING = "h long, node binary, n long, lone long, place long"


def _post(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """One row for each shared shingle in the prefix of a class."""
    for batch in batches:
        h, node, n, lone, place = [], [], [], [], []
        for r in batch.to_pylist():
            take = r["n"] - -(-num * r["n"] // den) + 1 - r["lone"]
            own = unpacked(r["shared"])[:take]
            h.append(own.astype(np.int64))
            node += [r["node"]] * len(own)
            n.append(np.full(len(own), r["n"], np.int64))
            lone.append(np.full(len(own), r["lone"], np.int64))
            place.append(r["lone"] + np.arange(len(own)))
        if node:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(h)), pa.array(node, pa.binary()), *(pa.array(np.concatenate(x)) for x in (n, lone, place))],
                names=["h", "node", "n", "lone", "place"],
            )


def _verify(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Whether the whole sets of each pair reach the threshold."""
    for batch in batches:
        keep = []
        for r in batch.to_pylist():
            both = len(np.intersect1d(unpacked(r["ta"]), unpacked(r["tb"]), True))
            keep.append(den * both >= num * (r["na"] + r["nb"] - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep)], names=["a", "b", "linked"])


def _shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shared shingles of a class fall into each part of the hash space."""
    for batch in batches:
        shapes = [
            np.bincount((unpacked(t) >> np.uint64(44)).astype(np.int64), minlength=SHAPE).tolist()
            for t in batch.column(3).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(shapes, pa.list_(pa.int32()))], names=["node", "n", "lone", "shared", "shape"]
        )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b): the smallest node that it is connected with.

    Alternating large-star and small-star steps; both only aggregate and join, so a node
    with millions of edges is spread like any other rows.
    """
    def canonical(frame: DataFrame) -> DataFrame:
        return frame.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = durable(canonical(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    before, after = None, state(now)
    while before != after and after[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, now = now, durable(canonical(small.unionByName(low.select("u", F.col("m").alias("v")))))
        release(last)
        before, after = after, state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _alike(num: int, den: int):
    """Length and positional filter on two postings ``x`` and ``y`` of one shingle."""
    need = F.expr(f"-floor(-{num} * (x.n + y.n) / ({num} + {den}))")
    most = (
        F.least(F.col("x.place") - F.col("x.lone"), F.col("y.place") - F.col("y.lone"))
        + 1
        + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
        - 1
    )
    longer, shorter = F.greatest("x.n", "y.n"), F.least("x.n", "y.n")
    return (F.lit(den) * shorter >= F.lit(num) * longer) & (most >= need)


def _links(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Labels (node, root) of the classes that are connected with others."""
    spark = classes.sparkSession
    postings = durable(
        classes.select("node", "n", "lone", "shared").mapInArrow(lambda it: _post(it, num, den), _POSTING)
    )
    total = postings.count()
    lists = classes.select("node", "shared")
    shapes = classes.select("node", "n", "shape")
    asked = edges = None
    labels = spark.createDataFrame([], "node binary, root binary")

    def verified(pairs: DataFrame) -> DataFrame:
        """(a, b, linked) of pairs not asked before, after the suffix filter."""
        if asked is not None:
            pairs = pairs.join(asked, ["a", "b"], "left_anti")
        x, y = shapes.toDF("a", "na", "sa"), shapes.toDF("b", "nb", "sb")
        bound = F.expr("aggregate(zip_with(sa, sb, (p, q) -> least(p, q)), 0L, (s, v) -> s + v)")
        need = F.expr(f"-floor(-{num} * (na + nb) / ({num} + {den}))")
        pairs = pairs.join(x, "a").join(y, "b").where(bound >= need).select("a", "b", "na", "nb")
        pairs = pairs.join(lists.toDF("a", "ta"), "a").join(lists.toDF("b", "tb"), "b")
        return durable(
            pairs.select("a", "b", "na", "nb", "ta", "tb").mapInArrow(
                lambda it: _verify(it, num, den), "a binary, b binary, linked boolean"
            )
        )

    for turn in range(HUB_ROUNDS + 1):
        # A class without a label is a component of its own.
        placed = postings.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if turn:
            placed = durable(placed)
        parts = placed.groupBy("h", "root").agg(F.count("*").alias("k"))
        lists_open = parts.groupBy("h").agg(
            F.count("*").alias("parts"), ((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("pairs")
        ).where("parts > 1")
        if turn:
            left = lists_open.agg(F.sum("pairs")).first()[0]
            if not left:
                break
        every = turn and (left <= 2 * total + 100_000 or turn == HUB_ROUNDS)
        if every:
            # Members of a long list are dealt into blocks, and each pair of blocks is a key of its own.
            sized = durable(parts.groupBy("h").agg(F.count("*").alias("parts"), F.sum("k").alias("k")).where("parts > 1"))
            many = F.ceil(F.col("k") / LIST_BLOCK).cast("int")
            still = placed.join(sized.select("h", many.alias("many")), "h")
            still = still.withColumn("own", F.pmod(F.xxhash64("node"), F.col("many")).cast("int"))
            x = still.withColumn("other", F.explode(F.sequence(F.col("own"), F.col("many") - 1))).alias("x")
            y = still.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("own")))).alias("y")
            same = (F.col("x.h") == F.col("y.h")) & (F.col("x.own") == F.col("y.other")) & (F.col("x.other") == F.col("y.own"))
            once = (F.col("x.own") < F.col("y.own")) | (F.col("x.node") < F.col("y.node"))
            found = x.join(y, same).where(once & (F.col("x.root") != F.col("y.root")) & _alike(num, den))
            pairs = found.select(
                F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
            ).distinct()
        else:
            # The hub of a list is the same for all lists of a group as far as possible.
            rank = F.struct(F.xxhash64("node", F.lit(turn)).alias("r"), "node", "root", "n", "lone", "place")
            hubs = placed.groupBy("h").agg(F.min(rank).alias("y"), F.min("root").alias("lo"), F.max("root").alias("hi"))
            hubs = hubs.where("lo != hi").select("h", "y")
            found = placed.alias("x").join(hubs, "h").where((F.col("x.root") != F.col("y.root")) & _alike(num, den))
            found = found.groupBy(F.col("x.node").alias("node"), F.col("y.node").alias("hub")).agg(F.count("*").alias("c"))
            # One hub for each class and turn: the one met in most lists.
            found = found.groupBy("node").agg(F.max(F.struct("c", "hub")).alias("best"))
            pairs = found.select(
                F.least("node", "best.hub").alias("a"), F.greatest("node", "best.hub").alias("b")
            ).distinct()
        answer = verified(pairs)
        asked = answer.select("a", "b") if asked is None else asked.unionByName(answer.select("a", "b"))
        linked = answer.where("linked").select("a", "b")
        edges = linked if edges is None else edges.unionByName(linked)
        labels = components(edges)
        if every:
            break
    return labels


def _resolve(table: pa.Table, num: int, den: int) -> pa.Table:
    """Links within one cluster, as (a, b) with b the smallest class connected with a."""
    rows = sorted(table.to_pylist(), key=lambda r: r["node"])
    count = len(rows)
    n = np.array([r["n"] for r in rows], np.int64)
    lone = np.array([r["lone"] for r in rows], np.int64)
    sets = [unpacked(r["shared"]) for r in rows]
    take = n - -(-num * n // den) + 1 - lone
    shapes = np.stack([np.bincount((x >> np.uint64(44)).astype(np.int64), minlength=SHAPE) for x in sets])

    def index(parts: list[np.ndarray]) -> tuple:
        """For each shingle of each class, where its members begin and end in ``members``."""
        owner = np.repeat(np.arange(count), [len(x) for x in parts])
        place = np.concatenate([np.arange(len(x)) for x in parts])
        _, number = np.unique(np.concatenate(parts), return_inverse=True)
        order = np.argsort(number, kind="stable")  # members ascend within a shingle
        begin = np.searchsorted(number[order], number)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        cut = np.cumsum([0, *map(len, parts)])
        return owner[order], place[order], begin, rank, cut

    whole, head = index(sets), index([x[:k] for x, k in zip(sets, take)])
    root = np.arange(count)
    for a in range(1, count):
        members, places, begin, rank, cut = head
        own = range(cut[a], cut[a + 1])
        # Members before a in the lists of its prefix shingles.
        slices = [(slice(begin[i], rank[i]), i - cut[a]) for i in own if rank[i] > begin[i]]
        if not slices:
            continue
        b = np.concatenate([members[x] for x, _ in slices])
        j = np.concatenate([places[x] for x, _ in slices])
        i = np.repeat([k for _, k in slices], [x.stop - x.start for x, _ in slices])
        need = -(-num * (n[a] + n[b]) // (num + den))
        long_enough = den * np.minimum(n[a], n[b]) >= num * np.maximum(n[a], n[b])
        most = np.minimum(i, j) + 1 + np.minimum(n[a] - lone[a] - i, n[b] - lone[b] - j) - 1
        b = np.unique(b[long_enough & (most >= need)])
        b = b[root[b] != root[a]] if len(b) else b
        if not len(b):
            continue
        bound = np.minimum(shapes[a], shapes[b]).sum(axis=1)
        b = b[bound >= -(-num * (n[a] + n[b]) // (num + den))]
        if not len(b):
            continue
        members, _, begin, rank, cut = whole
        common = np.concatenate([members[begin[i] : rank[i]] for i in range(cut[a], cut[a + 1])])
        both = np.bincount(common, minlength=count)[b]
        linked = b[den * both >= num * (n[a] + n[b] - both)]
        if len(linked):
            joined = np.unique(root[np.r_[linked, a]])
            root[np.isin(root, joined)] = joined[0]
    moved = np.flatnonzero(root != np.arange(count))
    nodes = [r["node"] for r in rows]
    return pa.table(
        {"a": pa.array([nodes[i] for i in moved], pa.binary()), "b": pa.array([nodes[root[i]] for i in moved], pa.binary())}
    )


def _labels(index: DataFrame, num: int, den: int) -> DataFrame:
    """(node, root) of all classes that are connected with others.

    ``index`` is a stored table; a class may stand in several of its rows, one for each block.
    Only keys and sizes move until the clusters are known; then the shingles move once to their
    class and once to their cluster.
    """
    postings = index.select("node", "n", "lone", "shared").mapInArrow(lambda it: _post(it, num, den), _POSTING)
    postings = durable(postings.select("h", "node"))
    # Every list as a star around its smallest member: the clusters of candidates.
    hubs = postings.groupBy("h").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b != last")
    stars = postings.join(hubs.select("h", "b"), "h").where("node != b").select(F.col("node").alias("a"), "b").distinct()
    clusters = components(stars)
    release(postings)
    clusters = durable(clusters.unionByName(clusters.select(F.col("root").alias("node"), "root").distinct()))
    sizes = index.select("node", F.octet_length("shared").alias("bytes")).distinct().join(clusters, "node")
    held = durable(sizes.groupBy("root").agg(F.count("*").alias("k"), (F.sum("bytes") / SHINGLE_BYTES).alias("shingles")))
    small = (F.col("k") <= CLUSTER) & (F.col("shingles") <= CLUSTER_SHINGLES)

    def members(which: Column) -> DataFrame:
        """Every class of some clusters once, with its shingles."""
        nodes = durable(clusters.join(held.where(which).select("root"), "root", "left_semi"))
        return index.select("node", "n", "lone", "shared").join(nodes, "node").dropDuplicates(["node"])

    fit = members(small)
    edges = durable(fit.groupBy("root").applyInArrow(lambda t: _resolve(t, num, den), "a binary, b binary"))
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    if held.where(~small).limit(1).count():
        shaped = "node binary, n long, lone long, shared binary, shape array<int>"
        large = durable(members(~small).select("node", "n", "lone", "shared").mapInArrow(_shape, shaped))
        labels = labels.unionByName(_links(large, num, den))
    return labels


def _rooted(
    docs: DataFrame, id_col: str, text_col: str, width: int, threshold: tuple, mark: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, key, mark) of the rows without words, and of the others with ``root``, the class of the group."""
    num, den = threshold
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        *([] if mark is None else [mark.alias("mark")]),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(48, size // (6 * RANGE_SHINGLES))
    spoken = rows.mapInArrow(lambda it: _speak(it, width, ranges), _MESSAGE)
    counted = spoken.groupBy("key").applyInArrow(_count, _MESSAGE)
    facts = durable(counted.groupBy("block").applyInArrow(lambda t: _hear(t, num, den), _FACT_ROWS))
    index = facts.where("shared is not null").select(F.col("key").alias("node"), "n", "lone", "shared")
    labels = _labels(index, num, den).withColumnRenamed("node", "key")
    small = facts.select("doc_id", "n", "key", "mark")
    full = small.where("n > 0").join(labels, "key", "left").withColumn("root", F.coalesce("root", "key"))
    return small.where("n = 0"), full


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: tuple = THRESHOLD
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for each row of ``docs``.

    Two documents link when ``den * |A & B| >= num * |A | B|`` for ``threshold = (num, den)``;
    ``component_id`` is the smallest id that a document reaches by links, its own included.
    """
    empty, full = _rooted(docs, id_col, text_col, width, threshold)
    empty = empty.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    # A table of its own, so that the join is of two plain shuffles and a root with many rows can be split.
    smallest = durable(full.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    full = full.join(smallest, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(empty)


def survivors(
    docs: DataFrame, mark: Column, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: tuple = THRESHOLD
) -> DataFrame:
    """``mark`` (16 bytes that stand for id and text) of one row of each group of ``near_groups``.

    It is the row with the smallest id, a missing id last.  Rows without words are in no group.
    """
    _, full = _rooted(docs, id_col, text_col, width, threshold, mark)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "mark"))
    return full.groupBy("root").agg(first.alias("first")).select("first.mark")
