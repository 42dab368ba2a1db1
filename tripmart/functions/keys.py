"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that stands in for a NULL input, so NULL gets a key of
# its own instead of nulling the whole key.
KEY_NULL = "_null_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """32-hex md5 of the inputs' text forms joined by ``-``.

    Contract: booleans render ``true``/``false``, timestamps
    ``yyyy-MM-dd HH:mm:ss[.ffffff]`` (Spark's zone-free cast of
    TIMESTAMP_NTZ), NULL renders :data:`KEY_NULL`. The key is a pure
    function of its inputs, so the same trip gets the same key in every
    batch and on every executor. 128 bits keep accidental collisions out of
    reach at 10^12 rows, which a 64-bit hash would not.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
