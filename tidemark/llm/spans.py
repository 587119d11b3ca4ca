"""Offsets of matches and replacement of spans in whole texts, in DataFrame functions only.

A text split by a pattern and the matches of the pattern alternate, so running lengths of both
give the offsets of every match in code points.  Arrays are walked in blocks of ``BLOCK``
elements: within a block a running value costs the square of the block, across blocks the square
of their number, so that a text with a million matches stays affordable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(values: Column) -> Column:
    last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK)))


def _steps(values: Column, base: Column, merge: Callable[[Column, Column], Column]) -> Column:
    begin = F.struct(base.alias("at"), F.slice(values, 1, 0).alias("seen"))
    return F.aggregate(
        values,
        begin,
        lambda s, x: F.struct(merge(s["at"], x).alias("at"), F.concat(s["seen"], F.array(s["at"])).alias("seen")),
        lambda s: s["seen"],
    )


def before(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each element what ``merge``, an associative function, makes of all elements before it."""

    def walk(blocks: Column) -> Column:
        bases = _steps(F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: merge(a, x))), zero, merge)
        return F.flatten(F.zip_with(blocks, bases, lambda b, base: _steps(b, base, merge)))

    return let(values, lambda v: F.when(F.size(v) == 0, v).otherwise(let(_blocks(v), walk)))


def matches(text: Column, pattern: str, near: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, end, hit, left, right).

    ``left`` and ``right`` are up to ``near`` characters around the match, as far as the
    neighbouring matches; the end is exclusive.
    """

    def placed(found: Column) -> Column:
        gaps, hits = found["gaps"], found["hits"]
        lengths = F.transform(hits, lambda h, i: F.char_length(F.get(gaps, i)) + F.char_length(h))

        def item(at: Column, i: Column) -> Column:
            start = at + F.char_length(F.get(gaps, i))
            hit = F.get(hits, i)
            left = F.right(F.get(gaps, i), F.lit(near)) if near else F.lit("")
            right = F.left(F.get(gaps, i + 1), F.lit(near)) if near else F.lit("")
            return F.struct(
                start.alias("start"), (start + F.char_length(hit)).alias("end"),
                hit.alias("hit"), left.alias("left"), right.alias("right"),
            )

        return F.transform(before(lengths, F.lit(0), lambda a, b: a + b), item)

    found = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")
    )
    none = F.lit(None).cast("array<struct<start:int,end:int,hit:string,left:string,right:string>>")
    return F.coalesce(F.when(text.rlike(pattern), let(found, placed)).otherwise(none), F.array().cast(
        "array<struct<start:int,end:int,hit:string,left:string,right:string>>"
    ))


def replace(text: Column, found: Column, mark: str) -> Column:
    """``text`` with every span of ``found`` (start, end) replaced by ``mark``; overlapping spans become one."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def write(spans: Column) -> Column:
        reached = before(F.transform(spans, lambda s: s["end"]), F.lit(0), F.greatest)
        gaps = F.zip_with(spans, reached, lambda s, r: F.struct(r.alias("a"), s["start"].alias("b")))
        opened = F.filter(gaps, lambda g: g["b"] >= g["a"])

        def block(b: Column) -> Column:
            first, last = F.get(b, F.lit(0))["a"], F.get(b, F.size(b) - 1)["b"]
            return let(
                F.substring(text, first + 1, last - first),
                lambda own: F.transform(
                    b, lambda g: F.concat(F.substring(own, g["a"] - first + 1, g["b"] - g["a"]), F.lit(mark))
                ),
            )

        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        body = let(opened, lambda o: F.array_join(F.flatten(F.transform(_blocks(o), block)), ""))
        return F.concat(body, F.substring(text, end + 1, F.char_length(text)))

    return F.when(F.size(found) > 0, let(ordered, write)).otherwise(text)
