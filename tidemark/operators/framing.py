"""Ordered computation over series of any length.

Two situations need different plans:

* **Daily grain.**  After a daily rollup or a keep-last dedupe there is one row per
  (series, day).  A window partition then holds at most one row per calendar day, however
  many raw readings the series has, so ``series_window`` (one shuffle on the key) is safe.
* **Raw grain.**  A single series may hold a large part of all rows.  The functions below
  never put a whole series into one task: the frame is sorted globally by (keys, order), the
  sorted partitions become *blocks*, and only one summary row per (keys, block) is
  combined across blocks.

``order`` must identify a row within its keys (add a tie-breaker), otherwise equal rows
fall into one block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..session import durable

BLOCK = "_block"
INDEX = "_index"
POSITION = "_pos"


def series_window(keys: Sequence[str], order: str | Sequence[str]) -> WindowSpec:
    """The window for frames with one row per (series, day)."""
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def rows_back(window: WindowSpec, size: int) -> WindowSpec:
    """The current row and the ``size - 1`` rows before it."""
    return window.rowsBetween(-(size - 1), Window.currentRow)


def cut_into_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Sort globally and store each row's sorted partition (block) and its place in there.

    Range partitioning samples the composite (keys, order), so a hot key is spread over as
    many blocks as its share of the rows asks for.  Labels are written with the rows, so they
    stay valid whatever is recomputed later.
    """
    labels = {BLOCK: F.spark_partition_id(), INDEX: F.monotonically_increasing_id()}
    return durable(df.orderBy(*keys, *order).withColumns(labels))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    *,
    overall: Mapping[str, str] | None = None,
    following: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Inclusive running sums per key without a one-task window.

    ``totals`` maps an output name to the column to add up.  ``overall`` maps one of these
    names to a column receiving the key's grand total; ``following`` maps an output name to a
    column whose value in the next row of the key is wanted.

    The rows are shuffled once more by (keys, block); the block summaries are partitioned the
    same way, so joining them moves nothing but the summaries.
    """
    blocks = cut_into_blocks(df, keys, order)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(INDEX)
    across = Window.partitionBy(*keys).orderBy(BLOCK)  # one row per block
    following = following or {}

    summary = blocks.groupBy(*keys, BLOCK).agg(
        *[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()],
        *[F.min_by(c, INDEX).alias(f"_first_{n}") for n, c in following.items()],
    )
    offsets = {f"_before_{n}": F.sum(f"_sum_{n}").over(across.rowsBetween(Window.unboundedPreceding, -1)) for n in totals}
    for name, target in (overall or {}).items():
        offsets[target] = F.sum(f"_sum_{name}").over(Window.partitionBy(*keys))
    for name in following:
        offsets[f"_next_{name}"] = F.lead(f"_first_{name}").over(across)
    summary = summary.withColumns(offsets).drop(
        *[f"_sum_{n}" for n in totals], *[f"_first_{n}" for n in following]
    )

    local = {n: F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, 0)) for n, c in totals.items()}
    local |= {n: F.lead(c).over(inside) for n, c in following.items()}
    joined = blocks.withColumns(local).join(summary, [*keys, BLOCK])
    finished = {n: F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0)) for n in totals}
    finished |= {n: F.coalesce(n, f"_next_{n}") for n in following}
    surplus = [f"_before_{n}" for n in totals] + [f"_next_{n}" for n in following]
    return joined.withColumns(finished).drop(*surplus, BLOCK, INDEX)


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = POSITION,
    *,
    total: str | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """Exact 1-based row number within each key, and on request the key's row count.

    The place inside a block is known from the sort, so only (keys, block) counts are
    combined; with few of them they are broadcast and the sorted rows are not moved again.
    """
    blocks = cut_into_blocks(df, keys, order)
    counts = blocks.groupBy(*keys, BLOCK).agg(F.count("*").alias("_rows"), F.min(INDEX).alias("_start"))
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    columns = [(F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_start") + 1).alias("_shift")]
    if total:
        columns.append(F.sum("_rows").over(Window.partitionBy(*keys)).alias(total))
    offsets = durable(counts.select(*keys, BLOCK, *columns))
    placed = blocks.join(offsets, [*keys, BLOCK]).withColumn(name, F.col(INDEX) + F.col("_shift"))
    return placed.drop("_shift", INDEX, *([] if keep_block else [BLOCK]))


def blocked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    halo: int,
    rows_per_block: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Run row-frame windows over series too long for one task.

    Each block of ``rows_per_block`` consecutive rows also receives the ``halo`` rows before
    it, so any frame reaching at most ``halo`` rows back sees exactly what a window over the
    whole series would show.  ``compute`` gets the frame and the window specification.
    """
    if halo > rows_per_block:
        raise ValueError("a block must be at least as long as its halo")
    placed = with_positions(df, keys, order)
    block = F.floor((F.col(POSITION) - 1) / rows_per_block)
    is_tail = F.pmod(F.col(POSITION) - 1, F.lit(rows_per_block)) >= rows_per_block - halo
    own = F.struct(block.alias(BLOCK), F.lit(True).alias("_own"))
    lent = F.struct((block + 1).alias(BLOCK), F.lit(False).alias("_own"))
    spread = placed.select("*", F.inline(F.when(is_tail, F.array(own, lent)).otherwise(F.array(own))))
    window = Window.partitionBy(*keys, BLOCK).orderBy(POSITION)
    return compute(spread, window).where("_own").drop("_own", BLOCK)


def nearest_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], known: Mapping[str, Column], *, blocks: bool = False
) -> DataFrame:
    """For each named column expression add ``<name>_before`` and ``<name>_after``.

    They hold the last non-NULL value at or before the row and the first one at or after it.
    Both directions use growing frames (one on the reversed order), so each costs one pass for
    all columns; a frame reaching to the end of the series would be recomputed for every row.
    The reversed pass comes first: the result is then in series order for what follows.  With ``blocks`` the frame carries the block labels of ``cut_into_blocks`` and
    only one summary row per block crosses from block to block.
    """
    parts = [*keys, BLOCK] if blocks else list(keys)
    upto = (Window.unboundedPreceding, Window.currentRow)
    forward = Window.partitionBy(*parts).orderBy(*order).rowsBetween(*upto)
    backward = Window.partitionBy(*parts).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(*upto)
    out = df.withColumns({f"{n}_after": F.last(c, True).over(backward) for n, c in known.items()})
    out = out.withColumns({f"{n}_before": F.last(c, True).over(forward) for n, c in known.items()})
    if not blocks:
        return out

    at = F.struct(*order)
    ends = df.groupBy(*parts).agg(
        *[F.max_by(c, F.when(c.isNotNull(), at)).alias(f"{n}_last") for n, c in known.items()],
        *[F.min_by(c, F.when(c.isNotNull(), at)).alias(f"{n}_first") for n, c in known.items()],
    )
    others = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(*others)
    later = Window.partitionBy(*keys).orderBy(F.desc(BLOCK)).rowsBetween(*others)
    carried = ends.select(
        *parts,
        *[F.last(f"{n}_last", True).over(earlier).alias(f"{n}_earlier") for n in known],
        *[F.last(f"{n}_first", True).over(later).alias(f"{n}_later") for n in known],
    )
    merged = {f"{n}_before": F.coalesce(f"{n}_before", f"{n}_earlier") for n in known}
    merged |= {f"{n}_after": F.coalesce(f"{n}_after", f"{n}_later") for n in known}
    surplus = [f"{n}_{side}" for n in known for side in ("earlier", "later")]
    return out.join(carried, parts).withColumns(merged).drop(*surplus)
