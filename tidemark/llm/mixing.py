"""Mixing sources to target weights by Pareto order sampling.

Targets.  Sources share the words of the mix by weight; a source stops at ``cap`` times its own
words and the excess is shared again by weight until none is above.

Sampling.  Within a source every document has an expected number of copies, in proportion to a
weight of the document and stopped at ``cap``, such that the expected words are the target.
Its whole copies are certain.  The rest is an inclusion probability p: with one uniform number u
per document, documents are ranked by the Pareto variable (u / (1 - u)) / (p / (1 - p)), and taken
in that order until the words still wanted are reached: a sample of fixed size, in words, with
unequal probabilities.  A document longer than what is still wanted is passed over, and the filling
goes on down the order until no document fits.  Then one further document, the one whose words fit best what is still
missing, closes the gap if that brings the source nearer to its target.

u is a hash of seed, id and text, so that reruns agree.

Hot sources: a source is ranked in ``CELLS`` cells of the Pareto variable; words are summed per
cell first (partial aggregation), and only the cell in which the target falls is ranked row by
row.  Cells with the whole source never meet in one task.  Tables joined to the documents have one row per source or per
(source, cell).

Edge cases: a missing text has size 0 and is never taken; the missing source is a source of its
own, last in order; rows that repeat are documents of their own, ranked by id and text hash and
then in arbitrary order, which changes no total; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import word_count
from tidemark.session import durable

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
CELLS = 4096
CELLS_PER_OCTAVE = 64  # of weights
SEED = 20_240_117


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target), one row per source of (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))  # over one row per source
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    totals = totals.withColumn("weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), place))
    every = Window.partitionBy()
    # Sources reach their limit in the order of limit / weight: one sorted pass finds the level.
    limit = F.col("source_size") * F.lit(float(cap))
    filled = Window.orderBy(limit / F.col("weight"), F.asc_nulls_last("source"))
    totals = totals.withColumn("limit", limit).select(
        "*",
        F.coalesce(F.sum("limit").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("below"),
        F.sum("weight").over(filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("rest"),
        (F.sum("source_size").over(every) * F.lit(float(share))).alias("all"),
    )
    level = (F.col("all") - F.col("below")) / F.col("rest")  # words per weight if all before are full
    totals = totals.withColumn("open", F.when(level * F.col("weight") <= F.col("limit"), level))
    totals = totals.withColumn("level", F.max("open").over(every))
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return totals.select("source", "source_size", target.alias("target"))


def expected_copies(rows: DataFrame, cap: int = CAP) -> DataFrame:
    """Add ``copies`` to (source, size, weight, target): cap or factor * weight, factors by source.

    The heaviest documents reach the cap first, so the factor is found from running totals in the order
    of the weights: over cells of like weight, then over the weights of the one cell in which it falls.
    With all documents before some weight at the cap and none from it on, the factor is what is left of
    the target by what is left of size times weight; the first weight that it does not bring above the
    cap decides.  Without words, or with a weight that is not positive, a document has no copies.
    """
    cell = F.floor(F.log2("weight") * CELLS_PER_OCTAVE)
    heavy = rows.where("weight > 0 and size > 0").select("source", "size", "weight", "target", cell.alias("cell"))

    def levels(groups: DataFrame, by: str, fixed: Column, loose: Column) -> DataFrame:
        """Factor and whether it fits for each group of (source, ``by``, words, mass, top)."""
        order = Window.partitionBy("source").orderBy(F.desc(by))
        before, now = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        groups = groups.withColumns(
            {"fixed": fixed + F.coalesce(F.sum("words").over(before), F.lit(0)), "loose": loose + F.sum("mass").over(now)}
        )
        factor = F.greatest(F.col("target") - cap * F.col("fixed"), F.lit(0.0)) / F.col("loose")
        groups = groups.withColumn("factor", F.when(F.col("loose") > 0, factor))
        return groups.withColumn("fits", F.coalesce(F.col("factor") * F.col("top") <= cap, F.lit(False)))

    def first_fit(by: str) -> Column:
        return F.max_by(F.when(F.col("fits"), F.col("factor")), F.when(F.col("fits"), F.col(by)))

    sums = (
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("weight")).alias("mass"),
        F.max("weight").alias("top"), F.first("target").alias("target"),
    )
    cells = durable(levels(heavy.groupBy("source", "cell").agg(*sums), "cell", F.lit(0), F.lit(0.0)))
    found = cells.groupBy("source").agg(first_fit("cell").alias("whole"), F.max(F.when(F.col("fits"), F.col("cell"))).alias("ok"))
    same = F.col("c.source").eqNullSafe(F.col("f.source"))
    open_ = cells.alias("c").join(found.alias("f"), same & (F.coalesce(F.col("c.cell") > F.col("f.ok"), F.lit(True))))
    split = open_.groupBy("c.source").agg(F.min_by(F.struct("c.cell", "c.fixed", (F.col("c.loose") - F.col("c.mass")).alias("loose")), "c.cell").alias("at"))
    split = durable(split.select("source", "at.*"))
    own = heavy.alias("c").join(split.alias("f"), same & (F.col("c.cell") == F.col("f.cell"))).select("c.*", "f.fixed", "f.loose")
    own = own.groupBy("source", "weight", "fixed", "loose").agg(*sums)
    inner = levels(own, "weight", F.col("fixed"), F.col("loose")).groupBy("source").agg(first_fit("weight").alias("part"))
    found = found.alias("c").join(inner.alias("f"), same, "left")
    most = F.lit(float("inf"))  # a target of cap times the whole source
    factors = durable(found.select("c.source", F.coalesce("f.part", "c.whole", most).alias("factor")))
    placed = rows.alias("c").join(factors.alias("f"), same, "left").select("c.*", "f.factor")
    copies = F.when((F.col("weight") > 0) & (F.col("size") > 0), F.least(F.lit(float(cap)), F.col("factor") * F.col("weight"))).otherwise(0.0)
    return placed.withColumn("copies", copies).drop("factor")


def _filled(rows: DataFrame) -> DataFrame:
    """Add ``extra``: 1 for the rows, in order, whose running words stay within ``missing`` of their key."""
    cells = rows.groupBy("key", "cell").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = durable(cells.select("*", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("earlier")))
    rows = rows.join(cells, ["key", "cell"])
    inside = (F.col("earlier") < F.col("missing")) & (F.col("earlier") + F.col("words") > F.col("missing"))
    rows = rows.withColumn("state", F.when(F.col("earlier") + F.col("words") <= F.col("missing"), 1).when(inside, 2).otherwise(0))
    order = Window.partitionBy("key", "cell").orderBy("rank", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = rows.where("state = 2").withColumn("reached", F.col("earlier") + F.sum("size").over(order))
    edge = edge.withColumn("extra", (F.col("reached") <= F.col("missing")).cast("int")).drop("reached")
    rest = rows.where("state != 2").withColumn("extra", F.col("state"))
    return edge.unionByName(rest).drop("words", "earlier", "state")


def mix(docs: DataFrame, weight: Column | None = None, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text_hash, size, source_size, target, copies, times and taken of every row of ``docs``.

    ``times`` is the number of copies that the mix takes, ``taken`` their words.
    ``weight`` (over doc_id, source, size) favours documents; the default treats all alike.
    The columns ``keep`` of ``docs`` pass through.
    """
    weight = F.lit(1.0) if weight is None else weight
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_hash"),
        *keep,
    )
    sizes = durable(rows)
    targets = durable(source_targets(sizes))
    rows = sizes.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    rows = durable(expected_copies(rows.select("d.*", "t.source_size", "t.target").withColumn("weight", weight)))
    whole = F.floor("copies")
    u = (F.xxhash64(F.lit(seed), "doc_id", "text_hash").cast("double") + F.lit(2.0**63) + 0.5) / F.lit(2.0**64)
    u = F.least(F.greatest(u, F.lit(1e-15)), F.lit(1 - 1e-15))
    rows = rows.withColumn("whole", whole).withColumn("p", F.col("copies") - whole).withColumn("u", u)
    # A missing source needs a key that is equal to itself.
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    pareto = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), pareto))
    rows = rows.withColumn("cell", F.floor(F.col("rank") / (1 + F.col("rank")) * CELLS))
    # Words of whole copies are certain; ``missing`` is what the sample has to bring.
    missing = rows.groupBy("key").agg((F.first("target") - F.sum(F.col("size") * F.col("whole"))).alias("missing"))
    missing = durable(missing)
    parts = [rows.where("rank is null").withColumn("extra", F.lit(0))]
    rows = rows.where("rank is not null")
    while True:
        # What is too long now is so in all later turns; each turn takes a document of every source that has one.
        placed = rows.join(missing, "key")
        parts.append(placed.where("size > missing").drop("missing").withColumn("extra", F.lit(0)))
        fit = placed.where("size <= missing")
        if not fit.limit(1).count():
            break
        filled = durable(_filled(fit).drop("missing"))
        parts.append(filled.where("extra = 1"))
        rows = filled.where("extra = 0").drop("extra")
        got = filled.groupBy("key").agg(F.sum(F.col("size") * F.col("extra")).alias("got"))
        missing = durable(
            missing.join(got, "key", "left").select("key", (F.col("missing") - F.coalesce("got", F.lit(0))).alias("missing"))
        )
    drawn = durable(reduce(DataFrame.unionByName, parts))
    got = missing
    left = drawn.where("extra = 0 and rank is not null").join(got.where("missing > 0"), "key")
    fit = F.struct(F.abs(F.col("missing") - F.col("size")).alias("off"), "rank", "doc_id", "text_hash")
    closing = left.groupBy("key").agg(F.min(fit).alias("c"), F.first("missing").alias("missing")).where("c.off < missing")
    closing = durable(closing.select("key", "c.doc_id", "c.text_hash", "c.rank", F.lit(1).alias("last")))
    same = (
        F.col("d.key").eqNullSafe(F.col("c.key"))
        & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))
        & (F.col("d.text_hash") == F.col("c.text_hash"))
        & (F.col("d.rank") == F.col("c.rank"))
        & (F.col("d.extra") == 0)
    )
    done = drawn.alias("d").join(closing.alias("c"), same, "left").select("d.*", F.coalesce("c.last", F.lit(0)).alias("last"))
    # Of rows that are alike in everything only one closes the gap.
    done = done.withColumn(
        "last",
        F.when(F.col("last") == 1, (F.row_number().over(Window.partitionBy("key", "doc_id", "text_hash", "last").orderBy("rank")) == 1).cast("int")).otherwise(0),
    )
    times = F.col("whole") + F.col("extra") + F.col("last")
    return done.select(
        "doc_id", "text_hash", "size", "source_size", "target", "copies",
        times.cast("long").alias("times"), (times * F.col("size")).cast("long").alias("taken"), *keep,
    )
