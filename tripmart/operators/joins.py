"""Join helpers: size-checked broadcast and deduplicated anti-joins."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broadcast a dimension only up to this many rows. An hour calendar of 50
# years is ~440k rows of ~120 bytes (~50 MB in the broadcast relation);
# beyond that the join falls back to a shuffle join that AQE may still
# convert at runtime from measured sizes.
BROADCAST_ROW_LIMIT = 500_000

# Proven upper bounds on row counts, per DataFrame object: set where the
# construction fixes the size (32 flag combinations, a calendar of known
# hours), or memoised after a count.
_ROW_BOUNDS: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def with_row_bound(df: DataFrame, rows: int) -> DataFrame:
    """Record that ``df`` has at most ``rows`` rows."""
    _ROW_BOUNDS[df] = rows
    return df


def row_bound(df: DataFrame, count: bool = True) -> int | None:
    """A proven upper bound on the rows of ``df``: recorded, else counted (and recorded)."""
    n = _ROW_BOUNDS.get(df)
    if n is None and count:
        n = df.count()
        _ROW_BOUNDS[df] = n
    return n


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT,
                      rows: int | None = None, basis: DataFrame | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only if it has at most ``limit`` rows.

    The size comes from ``rows``, else from the bound of ``basis`` (the
    dimension ``df`` projects or filters), else of ``df`` itself -- counted
    once when no bound is known, which is cheap for the dimension-sized
    inputs this is meant for.
    """
    n = rows if rows is not None else row_bound(basis if basis is not None else df)
    return F.broadcast(df) if n <= limit else df


def anti_join_keys(df: DataFrame, existing: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``keys`` do not occur in ``existing``.

    Equals ``NOT IN`` for the non-NULL keys it is used with, without the
    null-aware broadcast plan ``NOT IN`` forces. The existing side is cut to
    its distinct keys first: a partial aggregate collapses a hot key before
    the shuffle, and AQE splits a skewed partition of the probe side. With
    ``rows``, a known bound on the rows of ``existing``, a small existing
    side is broadcast and ``df`` is not shuffled.
    """
    held = existing.select(*keys).distinct()
    return df.join(held if rows is None else bounded_broadcast(held, rows=rows), keys, "left_anti")


def anti_join_increment(df: DataFrame, existing: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``anti_join_keys`` for an increment of at most ``rows`` rows against a
    much larger ``existing``.

    The large side is cut to the keys it shares with the increment first, a
    semi-join. Up to the broadcast limit that join moves no row of the large
    side. Beyond it, Spark's run-time Bloom filter of the increment's keys
    (``SQL_CONF``; the increment must carry a filter) drops rows of the large
    side before the shuffle. What is left is no more than the increment.
    """
    asked = bounded_broadcast(df.select(*keys).distinct(), rows=rows)
    shared = existing.select(*keys).join(asked, keys, "left_semi")
    return anti_join_keys(df, shared, keys, rows)
