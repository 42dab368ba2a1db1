"""Harmonic packing of token ids into sequences of bounded length.

A sequence holds ``capacity`` tokens. Class k of harmonic packing takes
pieces that fit k times into a sequence, and each of its bins is filled with
exactly k pieces. Documents may be cut, so every document is cut at the
upper bounds of the classes, ``capacity // k``: a piece then fills its slot,
and a full bin wastes less than one token a piece. Bins are filled
independently of each other: a piece's bin follows from its rank in its
class, and ranks come from per-task counts, so no worker waits for another
and no piece is shuffled to find its bin. What is left (less than one bin a
class, a bounded number of pieces) is laid out by counts alone.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripmart.llm.common import documents, map_batches, stored

#: Bytes of pre-tokens kept with their ids in a Python worker (it starts
#: afresh beyond that), what one takes besides its characters, and the longest kept.
CACHE_BYTES, PART_BYTES, CACHE_CHARS = 192 << 20, 200, 48

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("task", T.IntegerType()), T.StructField("local_rank", T.LongType()),
])


class WordIds(dict):
    """Token ids of pre-tokens, as little-endian unsigned 32-bit integers.

    The tokenizer normalises, cuts a text into pre-tokens that hold no white
    space, and encodes each on its own, so their ids can be kept. Text of
    ASCII and Latin-1 letters without the special tokens' opening is cut into
    lower-case pre-tokens here. A text with anything else is cut at blanks and
    line feeds, and its words of other characters are encoded whole.
    """

    # Fixed value: the tokenizer's own pattern, for lower-case Latin-1.
    PART = re.compile(r"[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
    OTHER = re.compile(r"[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]|<\|")

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        super().__init__()
        self.held, self.cache_bytes = 0, cache_bytes
        self.tokenizer = Tokenizer.from_file(path)

    def __missing__(self, part: str) -> bytes:
        ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(part) <= CACHE_CHARS:
            self.held += PART_BYTES + len(part) + len(found)
            if self.held > self.cache_bytes:
                self.clear()
                self.held = 0
            self[part] = found
        return found

    def _parts(self, text: str) -> list[str]:
        return self.PART.findall(text.lower())

    def of(self, text: str) -> bytes:
        if self.OTHER.search(text):
            words = text.replace("\n", " ").split(" ")
            parts = [p for w in words for p in ([w] if self.OTHER.search(w) else self._parts(w))]
        else:
            parts = self._parts(text)
        return b"".join(map(self.__getitem__, parts))


def slot_sizes(capacity: int) -> list[int]:
    """Slot sizes of the classes, ascending: capacity // k for each k."""
    return sorted({capacity // k for k in range(1, capacity + 1)})


def cut(tokens: int, sizes: list[int]) -> Iterator[int]:
    """Cut a length into slot sizes, the largest first."""
    while tokens >= sizes[-1]:
        yield sizes[-1]
        tokens -= sizes[-1]
    while tokens:
        size = sizes[bisect_right(sizes, tokens) - 1]
        yield size
        tokens -= size


_TOKENIZERS: dict[tuple[str, int], WordIds] = {}


def _pieces(batches: Iterator[pd.DataFrame], tokenizer: str, end_id: int, capacity: int,
            cache_bytes: int) -> Iterator[pd.DataFrame]:
    if (tokenizer, cache_bytes) not in _TOKENIZERS:
        _TOKENIZERS[tokenizer, cache_bytes] = WordIds(tokenizer, cache_bytes)
    ids_of = _TOKENIZERS[tokenizer, cache_bytes]
    sizes, end = slot_sizes(capacity), end_id.to_bytes(4, "little")
    task, rank = TaskContext.get().partitionId(), dict.fromkeys(sizes, 0)
    columns = [f.name for f in PIECES]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True):
            ids = (ids_of.of(text) if text else b"") + end
            start, total = 0, len(ids) // 4
            for size in cut(total, sizes):
                crc = zlib.crc32(ids[4 * start:4 * (start + size)])
                rows.append((doc_id, start, size, crc, total, task, rank[size]))
                rank[size] += 1
                start += size
        out = pd.DataFrame(rows, columns=columns)
        out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
        yield out


def layout(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (size, first rank, end rank, first sequence, offset).

    Ranks of one row follow each other in sequences of ``capacity // size``
    pieces. The first row of a class covers its full bins. The others place
    the rest, less than a bin a class: sequences are filled with the largest
    pieces first, exactly to the capacity or to a smaller power of two (which
    needs no padding) where the remaining pieces allow it.
    """
    rows, seq, left, used = [], 0, {}, {}
    for size, n in sorted(counts.items(), reverse=True):
        k = capacity // size
        full = n // k
        rows.append((size, 0, full * k, seq, 0))
        seq += full
        left[size], used[size] = n - full * k, full * k
    while any(left.values()):
        total = sum(s * n for s, n in left.items())
        targets = [capacity] + [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if 1 << b <= total]
        for i, target in enumerate([*targets, capacity]):
            space, take = target, {}
            for size, n in left.items():
                take[size] = min(n, space // size)
                space -= take[size] * size
            if not space or i == len(targets):
                break
        at = 0
        for size, n in take.items():
            if n:
                rows.append((size, used[size], used[size] + n, seq, at))
                at += n * size
                used[size] += n
                left[size] -= n
        seq += 1
    return rows


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096,
         cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of ``capacity`` tokens.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. A null or empty text is the end id alone; repeated
    rows and null ids are documents of their own; other columns are ignored.
    ``cache_bytes`` bounds the pre-tokens that a Python worker keeps, also after
    the job, as long as Spark keeps the worker.
    """
    spark = docs.sparkSession
    pieces = stored(map_batches(
        docs.select("doc_id", "text"), lambda it: _pieces(it, tokenizer, end_id, capacity, cache_bytes), PIECES), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # At most one row a class: about 2 * sqrt(capacity) rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        layout(counts, capacity),
        "length long, first long, last long, seq long, at long")
    rank = pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("local_rank"))
    placed = rank.join(F.broadcast(plan), (rank["length"] == plan["length"]) & (rank["rank"] >= plan["first"])
                       & (rank["rank"] < plan["last"]))
    nth = F.col("rank") - F.col("first")
    per_bin = F.floor(F.lit(capacity) / rank["length"])
    return placed.select(
        "doc_id", "start", rank["length"].alias("length"), "ids_crc32", "doc_tokens",
        (F.col("seq") + F.floor(nth / per_bin)).alias("sequence_id"),
        (F.col("at") + F.pmod(nth, per_bin) * rank["length"]).alias("offset"),
    )


def op6_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)
