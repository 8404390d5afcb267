"""Array functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, f) -> Column:
    """f(value) with value computed once: a lambda variable is never inlined by the optimizer."""
    return F.element_at(F.transform(F.array(value), f), 1)


def running(values: Column) -> Column:
    """For each number the sum of those before it, as longs.

    Sums are taken in blocks of about the square root of the length: a sum inside the block is added to one over whole
    blocks. So n numbers cost n to the power of 1.5, and no array grows while it is folded.
    """
    zero = F.lit(0).cast("long")
    total = lambda xs: F.aggregate(xs, zero, lambda a, x: a + x)

    def sums(v: Column) -> Column:
        block = F.ceil(F.sqrt(F.size(v))).cast("int")

        def of_blocks(own: Column) -> Column:
            starts = F.transform(own, lambda _, b: total(F.slice(own, F.lit(1), b)))
            return bind(starts, lambda at: F.transform(v, lambda _, i: F.get(at, F.floor(i / block).cast("int")) + total(F.slice(v, i - i % block + 1, i % block))))

        return bind(F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int")), lambda b: total(F.slice(v, b * block + 1, block))), of_blocks)

    return bind(values, lambda v: F.when(F.size(v) > 0, sums(v)).otherwise(F.expr("cast(array() as array<bigint>)")))
