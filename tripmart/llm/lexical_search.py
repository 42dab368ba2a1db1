"""Ranked lexical search with the Best Position Algorithm.

Documents are cut into shards, in the order in which tasks read them; a shard
holds an impact list of each query term: its documents by falling impact. For
an item the lists of its terms are read downward side by side. A document
that is met for the first time is looked up in all other lists (direct
access), which gives its whole score and its positions there. A list's best
position is the last one up to which all positions were seen, by either kind
of access; the impacts at the best positions add up to the most that an unseen
document can score, and never to more than those at the last read positions.
Reading stops when that sum is strictly below the k-th best score, so that
documents of equal scores are all met.

No posting is shuffled. A task keeps its k best for each item across its
shards, which raises the score to beat; only those rows meet for the ranking.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import documents, map_batches, stored

TOP = 10
#: Postings of a shard (12 bytes each, and as much again while it is built).
SHARD_POSTINGS = 2_000_000
#: Distinct terms of the items that are looked up in one pass over the documents.
BLOCK_TERMS = 200_000
_PIECE = 1 << 20
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Of UTF-8 bytes: A-Z lower-cased, other letters, digits and bytes of longer characters kept, the rest blank.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 0x20
              for b in range(256))


def terms(text: Column) -> Column:
    """Terms in order, repeats included; null has none."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.regexp_extract_all(lower, F.lit(_TERM), F.lit(0)), F.array().cast("array<string>"))


def _counted(body: bytes, known: dict[bytes, int]) -> tuple[int, list[tuple[int, int]]]:
    """Number of terms of a text, and (term number, occurrences) of known terms."""
    folded, n, found = body.translate(_FOLD), 0, Counter()
    at = 0
    while at < len(folded):  # pieces end at a blank, so long texts need no list of all their terms
        end = len(folded) if len(folded) - at <= _PIECE else folded.find(b" ", at + _PIECE)
        end = len(folded) if end < 0 else end
        words = folded[at:end].split()
        n += len(words)
        found.update(words)
        if len(found) > 4 * _PIECE:  # forget terms of no item
            found = Counter({t: c for t, c in found.items() if t in known})
        at = end
    return n, sorted((known[t], c) for t, c in found.items() if t in known)


def _postings(vocabulary):
    """One row a document: its number of terms, the numbers and counts of the query terms it holds."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = vocabulary.value
        for frame in frames:
            rows = [_counted(b, known) if b is not None else (0, []) for b in frame["body"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n": [n for n, _ in rows],
                                "term": [np.array([t for t, _ in found], np.int32) for _, found in rows],
                                "tf": [np.array([c for _, c in found], np.int64) for _, found in rows]})
    return run


def _frequencies(size: int):
    """Document frequencies of a task's rows, summed before they are shuffled."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(size, np.int64)
        for frame in frames:
            if len(frame):
                df += np.bincount(np.concatenate(frame["term"].to_numpy()).astype(np.int64), minlength=size)
        held = np.flatnonzero(df)
        yield pd.DataFrame({"term": held, "df": df[held]})
    return run


def _length_norm(n: np.ndarray, documents_: int, terms_: int) -> np.ndarray:
    """100 - 75 + (75 * n * N) div L, exact beyond 64 bits."""
    if 75 * int(n.max(initial=0)) * documents_ < 1 << 63:
        return 25 + 75 * n * documents_ // terms_
    return np.array([25 + 75 * int(x) * documents_ // terms_ for x in n], np.int64)


class _Shard:
    """Impact lists of a run of documents, and their postings by document."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, term: list, tf: list, documents_: int, terms_: int):
        self.ids = ids
        sizes = np.array([len(t) for t in term])
        self.first = np.concatenate([[0], np.cumsum(sizes)])  # a document's postings are together
        self.term, tf = np.concatenate(term).astype(np.int64), np.concatenate(tf).astype(np.int64)
        norm = np.repeat(_length_norm(n, documents_, terms_), sizes)
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * norm)
        order = np.argsort((self.term << 20) | (1_000_000 - self.impact), kind="stable")  # lists, by falling impact
        self.order = order.astype(np.int32)
        self.doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[order]
        self.start = np.searchsorted(self.term[order], np.arange(self.term.max(initial=0) + 2))
        self.place = np.empty(len(order), np.int32)  # of a posting in all lists
        self.place[order] = np.arange(len(order), dtype=np.int32)

    def lists(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(wanted, len(self.start) - 2)
        first, last = self.start[at], self.start[at + 1]
        return first, np.where(at == wanted, last, first)

    def postings(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the postings of some documents, and how many each has."""
        sizes = self.first[docs + 1] - self.first[docs]
        return np.arange(sizes.sum()) + np.repeat(self.first[docs] - np.cumsum(sizes) + sizes, sizes), sizes


def _best(shard: _Shard, wanted: np.ndarray, weight: np.ndarray, everyones: np.ndarray, top: list, k: int) -> list:
    """The k best (-score, id is null, id) of ``top`` and the shard, by best positions.

    ``wanted``, ``weight``: the item's terms and their weights, repeats
    counted; ``everyones``: the weights by term number.
    """
    first, last = shard.lists(wanted)
    held = last > first
    first, last, weight = first[held], last[held], weight[held]
    if not len(first):
        return top
    begin = np.concatenate([[0], np.cumsum(last - first)])
    base = np.zeros(len(everyones), np.int64)  # where a term's list starts among the item's lists
    base[wanted[held]] = begin[:-1] - first
    seen = np.zeros(begin[-1] + len(first), bool)  # each list has an end mark that is never seen
    base[wanted[held]] += np.arange(len(first))
    begin = begin + np.arange(len(begin))
    length = last - first
    met = np.zeros(len(shard.ids), bool)
    best = np.zeros(len(first), np.int64)
    depth, step = 0, 16
    while depth < length.max():
        reach = np.minimum(length, depth + step)
        docs = np.unique(np.concatenate([shard.doc[f + min(depth, m):f + m] for f, m in zip(first, reach, strict=True)]))
        docs = docs[~met[docs]]
        met[docs] = True
        for i in range(0, len(docs), 20_000):
            some = docs[i:i + 20_000]
            at, sizes = shard.postings(some)
            of = shard.term[at]
            mine = everyones[of] > 0
            seen[base[of[mine]] + shard.place[at[mine]]] = True
            share = np.where(mine, everyones[of] * shard.impact[at], 0)
            score = np.add.reduceat(share, np.concatenate([[0], np.cumsum(sizes)[:-1]]))  # no document is without
            floor = -top[-1][0] if len(top) == k else 1
            good = np.flatnonzero(score >= max(1, floor))
            if len(good) > k:  # ties of the k-th stay
                good = good[score[good] >= np.partition(score[good], -k)[-k]]
            new = [(-int(score[g]), shard.ids[some[g]] is None, shard.ids[some[g]]) for g in good]
            top = sorted(top + new, key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))[:k]
        depth, step = depth + step, step * 2
        for j in range(len(first)):
            best[j] += int(np.argmin(seen[begin[j] + best[j]:begin[j + 1]]))
        edge = np.minimum(best, length - 1)  # an unseen document is below the best position
        bound = int((weight * np.where(best < length, shard.impact[shard.order[first + edge]], 0)).sum())
        if len(top) == k and bound < -top[-1][0]:
            break
    return top


def _search(items, size: int, documents_: int, terms_: int, k: int, shard_postings: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, tops, everyones = items.value, {}, np.zeros(size, np.int64)

        def finish(parts: list) -> None:
            shard = _Shard(*[np.concatenate([p[i] for p in parts]) for i in range(2)],
                           *[[x for p in parts for x in p[i]] for i in (2, 3)], documents_, terms_)
            for q, (wanted, weight) in asked.items():
                everyones[wanted] = weight
                tops[q] = _best(shard, wanted, weight, everyones, tops.get(q, []), k)
                everyones[wanted] = 0

        parts, held = [], 0
        for frame in frames:
            some = frame["term"].map(len).to_numpy() > 0
            frame = frame[some]
            if not len(frame):
                continue
            ids = np.array([None if pd.isna(x) else int(x) for x in frame["doc_id"]], object)
            parts.append((ids, frame["n"].to_numpy(), list(frame["term"]), list(frame["tf"])))
            held += int(frame["term"].map(len).sum())
            if held >= shard_postings:
                finish(parts)
                parts, held = [], 0
        if parts:
            finish(parts)
        rows = [(q, i, -score) for q, top in tops.items() for score, _, i in top]
        yield pd.DataFrame({"item": [r[0] for r in rows], "doc_id": pd.array([r[1] for r in rows], "Int64"),
                            "score": [r[2] for r in rows]})
    return run


def _block(docs: DataFrame, asked: DataFrame, k: int, shard_postings: int) -> DataFrame:
    """item, doc_id, score: the k best of each task for the items of one block."""
    spark = docs.sparkSession
    rows = asked.select("item", "term", "c").collect()  # the block's terms: bounded by BLOCK_TERMS
    names = sorted({r["term"] for r in rows})
    number = {t: i for i, t in enumerate(names)}
    known = spark.sparkContext.broadcast({t.encode(): i for t, i in number.items()})
    bodies = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("body"))
    held = stored(map_batches(bodies, _postings(known), "doc_id long, n long, term array<int>, tf array<long>"),
                  "postings")
    sums = held.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    n = sums["documents"]
    df = {r["term"]: r["df"] for r in map_batches(held.select("term"), _frequencies(len(names)), "term int, df long")
          .groupBy("term").agg(F.sum("df").alias("df")).collect()}  # a number for each term of the block
    items: dict[int, dict[int, int]] = {}
    for r in rows:
        t = number[r["term"]]
        weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) if t in df else 0
        if weight > 0:
            items.setdefault(r["item"], {})[t] = weight * r["c"]
    lists = spark.sparkContext.broadcast({q: (np.array(sorted(w), np.int64), np.array([w[t] for t in sorted(w)], np.int64))
                                          for q, w in items.items()})
    find: Callable = _search(lists, len(names), n, sums["terms"] or 1, k, shard_postings)
    return map_batches(held.where("size(term) > 0"), find, "item long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS,
         shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are
    ignored. Every row of ``docs`` is a document, repeated or not; equal
    scores come by doc_id, null ids last. Items equal in id and text are one
    item; rows that share an id only are ranked each. Null and wordless items,
    and items that no document scores above 0 for, have no rows; null texts
    have no terms and count as no document. Empty tables give no rows.

    Items are dealt into blocks of about ``block_terms`` terms (or one item);
    each block is a pass over the documents.
    """
    worded = (items.select("item_id", "text").distinct()
              .withColumn("item", F.monotonically_increasing_id()).withColumn("terms", terms(F.col("text"))))
    asked = stored(worded.select("item", "item_id", "terms"), "items")
    counted = stored(asked.select("item", F.explode("terms").alias("term")).groupBy("item", "term")
                     .agg(F.count("*").alias("c")), "item-terms")
    blocks = -(-counted.count() // block_terms)
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))
    found = None
    for b in range(blocks):
        some = _block(docs, counted.where(block == b), k, shard_postings)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return asked.selectExpr("item_id", "0 AS rank", "0L AS doc_id", "0L AS score").limit(0)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SQL_TERMS = ("unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              f"'{_TERM}'))")
OP12_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents),
item AS (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
word AS (SELECT d, {_SQL_TERMS} AS term FROM doc),
tf AS (SELECT d, term, count(*) AS tf FROM word GROUP BY d, term),
size AS (SELECT d, sum(tf)::BIGINT AS n FROM tf GROUP BY d),
whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM size),
weight AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, whole GROUP BY term, documents
), asked AS (SELECT q, term, count(*) AS c FROM (SELECT q, {_SQL_TERMS} AS term FROM item) GROUP BY q, term),
scored AS (
  SELECT q, d, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // terms))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (d), whole GROUP BY q, d
), ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored JOIN doc USING (d) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN item USING (q) WHERE rank <= {TOP}
"""
