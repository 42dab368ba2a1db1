"""Benchmark decontamination with SimHash windows and exact verification.

Texts are lower-cased words of letters and digits, compared by their
multisets of five-word shingles (fewer words: one shingle of all). A window
of a document has an item's number of words. Windows with too few of the
items' shingles to reach the threshold are passed over by counting; the
SimHash of each remaining window is looked up in a multi-index of the items'
fingerprints, and the weighted Jaccard similarity of shingles decides.

Multi-index: a fingerprint has BLOCKS blocks of bits. Two fingerprints at
most RADIUS apart agree in some block up to RADIUS // BLOCKS bits, so items
are filed under every block value that near to theirs and windows look up
their own block values. With RADIUS 23, a pair at similarity 0.8 (16 % of
bits expected to differ) is missed once in more than 100,000 pairs.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents, row_digest, stored
from tripmart.operators.joins import bounded_broadcast

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 23, 8


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles(word: Column) -> Column:
    """Hash of each run of SHINGLE words, in order, repeats included."""
    n = F.size(word)
    run = F.transform(F.sequence(F.lit(1), n - SHINGLE + 1), lambda i: F.xxhash64(
        *[F.element_at(word, i + k) for k in range(SHINGLE)]))
    short = F.array(F.xxhash64(F.array_join(word, " "), F.lit(SHINGLE)))
    return F.when(n >= SHINGLE, run).when(n > 0, short).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of 64-bit hashes."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, none, lambda a, h: a + F.call_function("shiftrightunsigned", h, b).bitwiseAND(one))
        return F.when(ones * 2 > F.size(hashes), F.call_function("shiftleft", one, b)).otherwise(none)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), none, lambda a, b: a.bitwiseOR(bit(b)))


def _block(fp: Column, i: int) -> Column:
    width = 64 // BLOCKS
    return F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _near(value: Column) -> Column:
    """All block values up to RADIUS // BLOCKS bits from ``value``."""
    width, reach = 64 // BLOCKS, RADIUS // BLOCKS
    masks = [sum(1 << b for b in some) for k in range(reach + 1) for some in combinations(range(width), k)]
    return F.transform(F.array(*map(F.lit, masks)), lambda m: value.bitwiseXOR(m))


def _needed(mine: Column, other: Column) -> Column:
    """Least number of common shingles of two multisets of these sizes."""
    return F.ceil(F.lit(SIMILARITY / (1 + SIMILARITY)) * (mine + other) - F.lit(1e-6)).cast("int")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key, item_id, similarity of contaminated documents and items.

    ``key`` is the row digest of id and text. ``docs``: doc_id, text; ``benchmark``: item_id, text; other columns are
    ignored. The similarity is the best of all windows of the item's size (a
    shorter document is one window). Null, empty and wordless texts match
    nothing. Rows equal in doc_id and text give one row an item. Items equal
    in text are each reported. An empty side gives an empty result.
    """
    # Words are a column of their own: a lambda must not compute them again.
    worded = benchmark.select("item_id", words(F.col("text")).alias("words"))
    count = benchmark.count()
    short = stored(worded.where(F.size("words").between(1, SHINGLE - 1)).distinct(), "short-items", count)
    items = stored(worded.where(F.size("words") >= SHINGLE)
                   .select("item_id", shingles(F.col("words")).alias("hashes")).distinct()
                   .withColumn("item", F.monotonically_increasing_id()), "items", count * 64)
    items = items.withColumn("m", F.size("hashes"))
    keyed = docs.select("doc_id", row_digest(), words(F.col("text")).alias("words"))
    candidates = _candidates(docs.select("doc_id", "text"), keyed, items)
    windows = stored(_windows(candidates), "windows").withColumns(
        {"a": F.xxhash64("window"), "b": F.xxhash64(F.lit(1), "window")})
    # A passage that many documents share is judged once.
    known = windows.count() * 64
    kinds = stored(windows.groupBy("m", "a", "b").agg(F.first("window").alias("window")), "kinds", known)
    close = stored(_similar(kinds, items), "similar", known)
    found = windows.select("doc_id", "key", "m", "a", "b").distinct().join(
        bounded_broadcast(close), ["m", "a", "b"]).select("doc_id", "key", "item_id", "similarity")
    return (found.unionByName(_whole(keyed, short))
            .groupBy("doc_id", "key", "item_id").agg(F.max("similarity").alias("similarity")))


def _candidates(docs: DataFrame, keyed: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, key, text, sizes: documents with starts of windows that hold
    enough of the items' shingles to reach the threshold, rows alike once.

    Only positions of known shingles are shuffled, and then the texts of
    documents that have such a window.
    """
    # One row for each shingle and item size, not each item.
    wanted = items.select(F.explode("hashes").alias("h"), "m").distinct()
    hashed = keyed.select("key", shingles(F.col("words")).alias("hashes"))
    # The outer form: a filter on the array's size would be moved below it
    # and compute the array again.
    hits = hashed.select("key", F.size("hashes").alias("n"), F.posexplode_outer("hashes").alias("p", "h")).join(
        bounded_broadcast(wanted), "h")
    found = hits.groupBy("key", "n", "m").agg(F.sort_array(F.collect_set("p")).alias("p"))
    found = found.withColumn("w", F.least("n", "m")).withColumn("need", _needed(F.col("w"), F.col("m")))

    def starts(i: Column) -> Column:
        """Starts of windows that hold hits i to i + need - 1 and not hit i - 1."""
        low = F.greatest(F.lit(0), F.get("p", i + F.col("need") - 1) - F.col("w") + 1,
                         F.coalesce(F.get("p", i - 1) + 1, F.lit(0)))
        high = F.least(F.get("p", i), F.col("n") - F.col("w"))
        return F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))

    placed = found.where("need > 0 and size(p) >= need").select("key", "m", "w", F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("p") - F.col("need")), starts)).alias("starts")).where("size(starts) > 0")
    per_doc = stored(placed.groupBy("key").agg(F.collect_list(F.struct("m", "w", "starts")).alias("sizes")), "placed")
    keys = bounded_broadcast(per_doc.select("key"), basis=per_doc)
    held = docs.withColumn("key", row_digest()).join(keys, "key", "left_semi")
    once = held.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    return stored(once.join(per_doc, "key"), "candidates", per_doc.count() * 64)


def _windows(candidates: DataFrame) -> DataFrame:
    """doc_id, key, m, window: a row for each window to look up."""
    worded = candidates.select("doc_id", "key", "sizes", words(F.col("text")).alias("words"))
    hashed = worded.select("doc_id", "key", "sizes", shingles(F.col("words")).alias("hashes"))
    return (hashed.select("doc_id", "key", "hashes", F.explode("sizes").alias("z"))
            .select("doc_id", "key", "hashes", "z.m", "z.w", F.explode("z.starts").alias("s"))
            .select("doc_id", "key", "m", F.slice("hashes", F.col("s") + 1, F.col("w")).alias("window")))


def _similar(kinds: DataFrame, items: DataFrame) -> DataFrame:
    """m, a, b, item_id, similarity of windows and items at SIMILARITY or more."""
    filed = items.withColumn("fp", simhash(F.col("hashes")))
    index = filed.select("item", "m", F.col("fp").alias("item_fp"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), _near(_block(F.col("fp"), i)).alias("values")) for i in range(BLOCKS)]))
        .alias("e")).select("item", "m", "item_fp", "e.block", F.explode("e.values").alias("value"))
    prints = kinds.select("m", "a", "b", simhash(F.col("window")).alias("fp"))
    asked = prints.select("m", "a", "b", "fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), _block(F.col("fp"), i).alias("value")) for i in range(BLOCKS)])).alias("e"))
    near = (asked.select("m", "a", "b", "fp", "e.*").join(index, ["m", "block", "value"])
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
            .select("m", "a", "b", "item").distinct())
    counts = (near.join(kinds, ["m", "a", "b"])
              .select("m", "a", "b", "item", F.size("window").alias("w"), F.explode("window").alias("h"))
              .groupBy("m", "a", "b", "item", "w", "h").agg(F.count("*").alias("c")))
    item_counts = items.select("item", F.explode("hashes").alias("h")).groupBy("item", "h").agg(
        F.count("*").alias("ic"))
    common = (counts.join(item_counts, ["item", "h"]).groupBy("m", "a", "b", "item", "w")
              .agg(F.sum(F.least("c", "ic")).alias("both")))
    similarity = F.col("both") / (F.col("w") + F.col("m") - F.col("both"))
    close = common.select("m", "a", "b", "item", similarity.alias("similarity")).where(F.col("similarity") >= SIMILARITY)
    return close.join(items.select("item", "item_id"), "item").drop("item")


def _whole(keyed: DataFrame, short: DataFrame) -> DataFrame:
    """Matches of items with fewer words than a shingle: one shingle of all,
    so a window is equal or not at all similar."""
    sizes = [r[0] for r in short.select(F.size("words")).distinct().collect()]  # at most SHINGLE - 1 numbers
    found = keyed.select("doc_id", "key", F.lit(None).cast("long").alias("item_id"),
                         F.lit(1.0).alias("similarity")).limit(0)
    for n in sizes:
        hit = keyed.select("doc_id", "key", F.explode_outer(_runs(n)).alias("run")).join(
            bounded_broadcast(short.select("item_id", F.array_join("words", " ").alias("run"))), "run")
        found = found.unionByName(hit.select("doc_id", "key", "item_id", F.lit(1.0).alias("similarity")))
    return found


def _runs(n: int) -> Column:
    """The different runs of ``n`` words of a text, joined by blanks."""
    some = F.transform(F.sequence(F.lit(1), F.size("words") - n + 1),
                       lambda i: F.array_join(F.slice("words", i, n), " "))
    return F.when(F.size("words") >= n, F.array_distinct(some))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id and the best similarity (see ``matches``)."""
    return matches(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
