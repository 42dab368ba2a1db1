"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """(node, root): every linked node and the smallest node it reaches.

    Large-star and small-star rounds (each a map-side combined minimum and a
    join on the node) until the edges no longer change; the number of rounds
    grows with the logarithm of a component's diameter. Each round is written
    to the shared folder. Nothing but two numbers a round reaches the driver.
    ``rows``, where known, is about the number of links (see ``stored``).
    """
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(),
                   "edges", rows)
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(small, "edges", 2 * mark[0])
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
