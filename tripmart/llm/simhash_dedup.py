"""SimHash near-duplicate detection with BK-trees.

Every text gets a 64-bit SimHash. Equal fingerprints are one item. Two items
within the radius r differ in at most r of m bit blocks, so they agree on
some m - r blocks: an item is dealt to one shard for each choice of m - r
blocks, and each linked pair meets in at least one shard. In a shard a
BK-tree (children keyed by their Hamming distance to the parent) answers
every item's radius query, following only the edges the triangle inequality
allows. A shard's tree stays in the task that holds the shard: broadcasting
trees would pass all fingerprints through the driver. A shard with more
items than a tree may hold is cut into chunks, and every pair of chunks
(tree of one, queries of the other) is a task's work of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents, map_batches, row_digest, shuffle_width, stored
from tripmart.llm.components import components

#: Items of one tree; larger shards are cut into chunks.
TREE_ITEMS = 4096
#: Items a task holds at once (whole shards), and rows of a search frontier.
BLOCK_ITEMS = 1 << 16
FRONTIER = 1 << 20
#: Shingles counted at once.
COUNT_ROWS = 1 << 17


def simhash(text: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text (see the query's contract)."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts, size = [0, *ends], min(shingle, n)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b - 1], 42) for a, b in zip(starts, ends[size - 1:], strict=False)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNT_ROWS):
        rows = np.array(hashes[i:i + COUNT_ROWS], np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = np.array([simhash(t, shingle) for t in batch.pop("text")], np.uint64).view(np.int64)
        yield batch.assign(fp=prints)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, row digest (key) and fp, the signed form of the SimHash, a row each."""
    return map_batches(docs.select("doc_id", row_digest(), F.col("text").cast("binary").alias("text")),
                       lambda it: _fingerprints(it, shingle), "doc_id long, key binary, fp long")


def shard_keys(fp: Column, radius: int, blocks: int) -> Column:
    """Array of shard keys of a fingerprint: the choice, then its bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for i, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in kept)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


def build_forest(prints: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, ...]:
    """BK-trees of items sorted by ``tree``, all trees level by level.

    Returns the parent item, the distance to it, and each tree's root. In a
    round the first item of every group becomes a node; the others move on to
    the group of that node and their distance to it.
    """
    n = len(prints)
    parent, edge = np.full(n, -1), np.zeros(n, np.int64)
    at, group = np.arange(n), tree
    above, length = parent.copy(), edge.copy()
    while len(at):
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        node = at[first]
        parent[node], edge[node] = above[first], length[first]
        owner = np.repeat(node, np.diff(np.r_[first, len(at)]))
        rest = np.ones(len(at), bool)
        rest[first] = False
        at, owner = at[rest], owner[rest]
        far = np.bitwise_count(prints[at] ^ prints[owner]).astype(np.int64)
        key = owner * 65 + far
        order = np.argsort(key, kind="stable")
        at, group, above, length = at[order], key[order], owner[order], far[order]
    return parent, edge


def within(prints: np.ndarray, tree: np.ndarray, asked: np.ndarray, asked_tree: np.ndarray,
           radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query index, item index) at most ``radius`` bits apart.

    ``prints`` are items sorted by tree; queries go to the root of their own
    tree and follow an edge e at a node at distance d if |d - e| <= radius.
    """
    parent, edge = build_forest(prints, tree)
    # Children of a node, ordered by their edge.
    key = (parent + 1) * 65 + edge
    child = np.argsort(key, kind="stable")
    key = key[child]
    roots = np.flatnonzero(parent < 0)
    root_of = np.searchsorted(tree[roots], asked_tree)
    ok = root_of < len(roots)
    ok[ok] = tree[roots][root_of[ok]] == asked_tree[ok]
    stack = [(np.flatnonzero(ok), roots[root_of[ok]])]
    while stack:
        query, node = stack.pop()
        if len(query) > FRONTIER:
            half = len(query) // 2
            stack += [(query[half:], node[half:]), (query[:half], node[:half])]
            continue
        if not len(query):
            continue
        far = np.bitwise_count(asked[query] ^ prints[node]).astype(np.int64)
        hit = far <= radius
        yield query[hit], node[hit]
        low = np.searchsorted(key, (node + 1) * 65 + np.maximum(far - radius, 0), "left")
        high = np.searchsorted(key, (node + 1) * 65 + np.minimum(far + radius, 64), "right")
        many = high - low
        query = np.repeat(query, many)
        first = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many)
        stack.append((query, child[first + np.arange(len(first))]))


class Roots:
    """Union-find over the items of one block."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            y = self.up[x]
            if (y == x).all():
                return y
            self.up[x] = self.up[y]
            x = y

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join all pairs; only pairs of different roots cost more."""
        while True:
            x, y = self.find(a), self.find(b)
            apart = x != y
            if not apart.any():
                return
            a, b = np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            np.minimum.at(self.up, a, b)


def _links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Spanning links of each block of whole tiles (rows sorted by tile)."""
    held: list[pd.DataFrame] = []

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        prints = rows["fp"].to_numpy().view(np.uint64)
        tile = rows.groupby(["choice", "bits", "i", "j"], sort=False).ngroup().to_numpy()
        roots = Roots(len(rows))
        mine = np.flatnonzero(rows["chunk"].to_numpy() == rows["i"].to_numpy())
        asks = np.flatnonzero(rows["chunk"].to_numpy() == rows["j"].to_numpy())
        for q, x in within(prints[mine], tile[mine], prints[asks], tile[asks], radius):
            roots.link(asks[q], mine[x])
        root = roots.find(np.arange(len(rows)))
        fp = rows["fp"].to_numpy()
        out = fp[root] != fp
        return pd.DataFrame({"a": fp[out], "b": fp[root][out]}).drop_duplicates()

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= BLOCK_ITEMS:
            rows = pd.concat(held, ignore_index=True)
            last = rows[["choice", "bits", "i", "j"]]
            open_tile = (last == last.iloc[-1]).all(axis=1).to_numpy()
            held = [rows[open_tile]]
            if not open_tile.all():
                yield solve(rows[~open_tile].reset_index(drop=True))
    if held and sum(map(len, held)):
        yield solve(pd.concat(held, ignore_index=True))


def links(items: DataFrame, radius: int, blocks: int, tree_items: int = TREE_ITEMS) -> DataFrame:
    """Links (a, b) that span the same components as all pairs of distinct
    fingerprints ``fp`` at most ``radius`` bits apart."""
    shards = items.select("fp", F.explode(shard_keys(F.col("fp"), radius, blocks)).alias("key")).select("fp", "key.*")
    large = (shards.groupBy("choice", "bits").agg(F.count("*").alias("n"))
             .select("choice", "bits", "n", F.ceil(F.col("n") / tree_items).cast("int").alias("chunks")).where("n > 1"))
    dealt = shards.join(large, ["choice", "bits"]).withColumn(
        "chunk", F.pmod(F.xxhash64("fp", "choice"), F.col("chunks")).cast("int"))
    tiles = dealt.select("fp", "choice", "bits", "chunk",
                         F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    tiles = tiles.select("fp", "choice", "bits", "chunk", F.least("chunk", "other").alias("i"),
                         F.greatest("chunk", "other").alias("j"))
    tile = ["choice", "bits", "i", "j"]
    dealt = tiles.repartition(shuffle_width(items.sparkSession), *tile).sortWithinPartitions(*tile)
    return map_batches(dealt, lambda it: _links(it, radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, blocks: int = 5) -> DataFrame:
    """doc_id, fingerprint (hex), component_id, component and key, a row each.

    ``component`` names a component whatever its ids are; ``key`` is the
    row's digest (its id and text together).

    ``blocks`` (more than ``radius``) sets the shards: 5 blocks keep 25 or 26
    bits in each of 10 keys, so a shard of random fingerprints holds about one
    item for each 50 million; take 6 (20 keys of 32 bits) beyond 10^12 texts.
    Null and empty texts have fingerprint zero and are linked like others. A
    null doc_id never names a component unless all ids in it are null.
    Repeated rows are kept, a row each. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    items = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    # A row is dealt to a shard for each choice of blocks, and links up once in it.
    shards = comb(blocks, radius)
    root = components(links(items.select("fp"), radius, blocks), "a", "b", prints.count() * shards)
    item_root = items.join(root, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = item_root.join(
        item_root.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
    return prints.join(named.drop("first_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("root").alias("component"), "key")


def op7_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=3, radius=3).select(
        "doc_id", "fingerprint", "component_id")
