"""Interleaved-bit (Z-order) keys for laying out rows by several columns at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def place(value: Column, low: Column, high: Column, bits: int) -> Column:
    """Place of a number in ``low`` to ``high``, as an integer of ``bits`` bits.

    Null, or a span of no width, is place 0; values outside are put at the ends.
    """
    width = F.nullif(high - low, F.lit(0)).cast("double")
    share = (value - low).cast("double") / width
    share = F.when(share < 0, 0.0).when(share > 1, 1.0).otherwise(share)
    return F.coalesce(F.floor(share * float(2**bits - 1)).cast("long"), F.lit(0).cast("long"))


def interleave(places: list[Column], bits: int) -> Column:
    """Long whose bits are those of ``places`` in turn, the highest ones first.

    Rows that are near each other in all places are near in this order, so a
    run of rows spans a short range of each place. At most 63 bits in all.
    """
    if not places or len(places) * bits > 63:
        raise ValueError(f"{len(places)} places of {bits} bits do not fit a long")
    n = len(places)
    parts = [F.shiftleft(F.shiftright(p, b).bitwiseAND(F.lit(1).cast("long")), b * n + n - 1 - i)
             for i, p in enumerate(places) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)
