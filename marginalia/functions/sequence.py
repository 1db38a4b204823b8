"""Ordered-sequence work inside one row, on array columns.

A document is one row, so what the operators does by walking a list can be done
on an array column of that row: no shuffle, no sort, no window.  All functions
are linear in the array length up to a square-root factor in ``running_total``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``.

    Without this the optimizer may inline an array expression into a lambda,
    where it would be computed again for every element.
    """
    return F.transform(F.array(value), body)[0]


def _scan(values: Column, kind: str = "int") -> Column:
    """Exclusive running total of a short array."""
    return F.aggregate(
        values,
        F.struct(F.lit(0).cast(kind).alias("sum"), F.array().cast(f"array<{kind}>").alias("out")),
        lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), F.array_append(acc["out"], acc["sum"]).alias("out")
        ),
        lambda acc: acc["out"],
    )


def running_total(values: Column, kind: str = "int") -> Column:
    """Sum of the earlier elements, for every element of an ``array<int>`` (or of ``kind``).

    Spark arrays are immutable, so one long fold would copy quadratically.  The
    array is cut in about sqrt(n) blocks; totals run inside and over blocks.
    """

    def blocks_of(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))
        return let(
            width,
            lambda w: F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), w),
                lambda first: F.slice(v, first + 1, w),
            ),
        )

    def last(block: Column) -> Column:
        return F.coalesce(F.get(block, F.size(block) - 1), F.lit(0).cast(kind))

    def added(blocks: Column, inside: Column) -> Column:
        """A block's total is its last running total and its last element."""
        totals = F.transform(blocks, lambda block, b: last(F.get(inside, b)) + last(block))
        return let(
            _scan(totals, kind),
            lambda bases: F.flatten(
                F.transform(inside, lambda block, b: let(F.get(bases, b), lambda base: F.transform(block, lambda x: x + base)))
            ),
        )

    return let(
        values,
        lambda v: let(
            blocks_of(v),
            lambda blocks: let(F.transform(blocks, lambda block: _scan(block, kind)), lambda inside: added(blocks, inside)),
        ),
    )


def positions(array: Column, test: Callable[[Column, Column], Column]) -> Column:
    """Indexes (from 0) of the elements for which ``test(element, index)`` holds."""
    return F.array_compact(F.transform(array, lambda x, i: F.when(test(x, i), i)))


def segments(bounds: Column, size: Column) -> Column:
    """``struct<first, last>`` per bound; a segment ends before the next bound."""
    return let(
        F.concat(bounds, F.array(size)),
        lambda b: F.transform(
            bounds, lambda first, k: F.struct(first.alias("first"), (F.get(b, k + 1) - 1).alias("last"))
        ),
    )


MARK = "\ue000"  # a private-use character put between pieces
MARKED_CHARS = 4_000_000  # longest text that is taken apart into characters


def starts(pieces: Column, gap: int) -> Column:
    """Start of every piece in the text made by joining them with ``gap`` blanks (0 or 1).

    The pieces are joined with a mark and the marks' positions read off, one
    light pass over the characters.  Texts that hold the mark themselves, and
    very long ones, take ``running_total``.
    """

    def read_off(joined: Column) -> Column:
        at = positions(F.split(joined, ""), lambda c, i: c == MARK)
        return F.concat(F.array(F.lit(0)), F.transform(at, lambda i, k: (i + 1) if gap else (i - k)))

    def choose(joined: Column, ps: Column) -> Column:
        marks = F.length(joined) - F.length(F.replace(joined, F.lit(MARK), F.lit("")))
        return F.when(
            (marks == F.size(ps) - 1) & (F.length(joined) <= MARKED_CHARS), read_off(joined)
        ).otherwise(running_total(F.transform(ps, lambda p: F.length(p) + gap)))

    return let(pieces, lambda ps: let(F.array_join(ps, MARK), lambda joined: choose(joined, ps)))


def counts_up_to(points: Column, marks: Column) -> Column:
    """For each of the ``points``, how many ``marks`` are <= it (all ints >= 0).

    One sort of both together: the r-th point in value order stands at index j,
    so j - r marks come before it.  A value, whether it is a point, and its index
    are packed into one long, so plain longs are sorted.
    """
    high, flag = 1 << 32, 1 << 31
    both = F.sort_array(
        F.concat(
            F.transform(marks, lambda m: m.cast("long") * high),
            F.transform(points, lambda p, k: p.cast("long") * high + flag + k),
        )
    )
    return let(
        both,
        lambda b: F.transform(
            F.sort_array(
                F.transform(
                    positions(b, lambda x, i: x.bitwiseAND(flag) != 0),
                    lambda j, r: F.get(b, j).bitwiseAND(flag - 1) * high + (j - r),
                )
            ),
            lambda x: x.bitwiseAND(high - 1).cast("int"),
        ),
    )
