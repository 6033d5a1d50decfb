"""Array expressions that stay near linear in an array's length.

``aggregate`` that appends to an array copies it at each step.  ``running``
works block by block instead: each block on its own, then the blocks' totals
(in blocks again), so a step copies at most ``BLOCK`` values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64
LEVELS = 3  # beyond BLOCK ** LEVELS values the topmost totals are one longer block
CHUNK = 256


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def add(a: Column, b: Column) -> Column:
    return a + b


def largest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _scan(values: Column, first: Column, step: Callable) -> Column:
    acc = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, acc, lambda a, v: F.struct(
        step(a["at"], v).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]


def running(values: Column, step: Callable, levels: int = LEVELS) -> Column:
    """What ``step`` (a sum or a maximum of non-negative ints) makes of all
    values before each one; 0 before the first.  As long as ``values``."""
    def in_blocks(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(v), F.lit(BLOCK)), lambda k: F.slice(v, k, BLOCK))

        def joined(b: Column) -> Column:
            totals = F.transform(b, lambda x: F.aggregate(x, F.lit(0), step))
            return F.flatten(F.zip_with(b, running(totals, step, levels - 1), lambda x, first: _scan(x, first, step)))
        return F.when(F.size(v) > BLOCK, bound(blocks, joined)).otherwise(_scan(v, F.lit(0), step))
    return bound(values, in_blocks) if levels > 1 else _scan(values, F.lit(0), step)


def count_below(ascending: Column, limit: Column) -> Column:
    """How many values of an ascending array are below ``limit``, by halving."""
    powers = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))
    return F.aggregate(powers, F.lit(0), lambda n, p: F.when(
        F.coalesce(F.get(ascending, n + p - 1) < limit, F.lit(False)), n + p).otherwise(n))


def chunks(text: Column) -> Column:
    """The text in runs of ``CHUNK`` code points, for ``cut``."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(parts: Column, start: Column, length: Column) -> Column:
    """substring(text, start + 1, length) from the text's ``chunks``, without
    reading the text from its beginning."""
    first = F.floor(start / CHUNK).cast("int")
    count = F.floor((start + length) / CHUNK).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(parts, first + 1, count), ""), start - first * CHUNK + 1, length)
