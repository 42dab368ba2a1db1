"""Removal of repeated byte strings with suffix arrays.

Documents are cut into pieces (see ``repeats``); each shard of pieces gets a
suffix array by Larsson-Sadakane refinement in numpy and common prefixes by
Kasai's recurrence. Two windows are equal if neighbours in the suffix array
share at least the window's length. Shards of one file number are merged by
binary search in the sorted digests of their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents, map_batches, row_key
from tripmart.llm.repeats import Spec, _groups, removal, repeated

_BYTE = np.random.default_rng(400).integers(0, 1 << 64, 256, np.uint64)
#: Symbols packed into the first sort key, nine bits each.
FIRST = 7
#: Suffixes followed by one lane of Kasai's recurrence.
LANE = 32


def refine(sa: np.ndarray, new: np.ndarray, end: np.ndarray, known: int, depth: int) -> np.ndarray:
    """Larsson-Sadakane refinement, in place, of suffixes sorted by ``known``
    symbols (``new``: first of a group) to ``depth`` or more; returns ranks.

    A suffix's rank is the first slot of its group. Each round sorts only
    groups with several members, by the rank of the suffix ``known`` further
    on, and doubles ``known``. ``end`` holds, for each position, where its
    piece ends; a suffix that ends earlier comes first.
    """
    n = len(sa)
    rank, slot = np.empty(n, np.int64), np.arange(n)
    rank[sa] = np.maximum.accumulate(np.where(new, slot, 0))
    at = slot
    while known < depth and len(at):
        at = at[~(new[at] & np.r_[new, True][at + 1])]
        if not len(at):
            break
        suffix = sa[at]
        ahead = suffix + known
        inside = ahead < end[suffix]
        key = rank[suffix] * (n + 1) + np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        order = np.argsort(key, kind="stable")
        suffix, key = suffix[order], key[order]
        sa[at] = suffix
        new[at] = np.r_[True, key[1:] != key[:-1]]
        rank[suffix] = np.maximum.accumulate(np.where(new[at], at, 0))
        known *= 2
    return rank


def suffix_array(text: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the pieces of ``text`` sorted to ``depth``, and ranks."""
    n = len(text)
    key, symbol = np.zeros(n, np.int64), np.r_[text, np.zeros(FIRST, np.uint8)].astype(np.int64) + 1
    room = end - np.arange(n)
    for t in range(FIRST):
        key = (key << 9) | np.where(room > t, symbol[t:t + n], 0)
    sa = np.argsort(key, kind="stable")
    key = key[sa]
    new = np.r_[True, key[1:] != key[:-1]]
    rank = refine(sa, new, end, FIRST, depth)
    return sa, rank


def common_prefixes(text: np.ndarray, end: np.ndarray, sa: np.ndarray, rank: np.ndarray, depth: int) -> np.ndarray:
    """Kasai: symbols each suffix shares with the one before it in ``sa``,
    at most ``depth``, by position.

    Many lanes run side by side, each over LANE consecutive positions, and
    carry their match on, less one. Suffixes of one group share ``depth``
    symbols or more; their order beyond is unknown, so nothing is carried on
    from them.
    """
    n = len(text)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    padded = np.r_[text, np.zeros(8, np.uint8)]
    word = np.zeros(n, np.uint64)
    for t in range(8):
        word |= padded[t:t + n].astype(np.uint64) << np.uint64(8 * t)
    word = np.r_[word, np.zeros(depth + 8, np.uint64)]
    shared = np.zeros(n, np.int64)
    lanes = np.arange(0, n, LANE)
    carried = np.zeros(len(lanes), np.int64)
    for t in range(LANE):
        i = lanes + t
        i = i[i < n]
        j = before[i]
        has = j >= 0
        same = has & (rank[i] == rank[j])
        limit = np.where(has, np.minimum(np.minimum(end[i] - i, end[j] - j), depth), 0)
        h = np.minimum(np.maximum(carried[:len(i)] - 1, 0), limit)
        live = np.flatnonzero(~same & (h < limit))
        while len(live):
            apart = word[i[live] + h[live]] ^ word[j[live] + h[live]]
            whole = apart == 0
            step = np.where(whole, 8, np.bitwise_count((apart & -apart) - np.uint64(1)) >> 3)
            h[live] = np.minimum(h[live] + step, limit[live])
            live = live[whole & (h[live] < limit[live])]
        shared[i] = np.where(same, limit, h)
        carried = np.where(same, 0, h)
    return shared


def _windows(rows: pd.DataFrame, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeated windows of a block of pieces, and one of each kind."""
    n = rows["n"].to_numpy().astype(np.int64)
    size = n + span - 1
    text = np.frombuffer(b"".join(rows["body"]), np.uint8)
    end = np.repeat(np.cumsum(size), size)
    sa, rank = suffix_array(text, end, span)
    long = common_prefixes(text, end, sa, rank, span)[sa] >= span
    removed, head = np.zeros(len(text), bool), np.ones(len(text), bool)
    removed[sa] = long | np.r_[long[1:], False]
    head[sa[long]] = False
    window = end - np.arange(len(text)) >= span
    return removed[window], head[window]


def _symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)


def _hashed(symbols: np.ndarray) -> np.ndarray:
    return _BYTE[symbols]


def _finish(batches: Iterator[pd.DataFrame], span: int, with_text: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for rows in _groups([len(t) for t in batch["text"]], 64 << 20):
            part, out = batch.iloc[rows], []
            for text, spans in zip(part["text"], part["spans"], strict=True):
                removed = runs = 0
                n = len(text)
                if spans is not None and len(spans):
                    gone = removal(spans, n, span)
                    removed, runs = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    text = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((n, removed, runs, hashlib.sha256(text).hexdigest(), text))
            done = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            done.insert(0, "doc_id", part["doc_id"].astype("Int64").to_numpy())
            yield done if with_text else done.drop(columns="kept")


def remove_repeats(docs: DataFrame, span: int = 400, gram: int = 32, with_text: bool = False) -> DataFrame:
    """Remove every byte covered by a ``span``-byte string that starts twice.

    ``docs``: doc_id, text; other columns are ignored. Returns doc_id,
    n_bytes, n_removed, n_spans, kept_sha256 (and with ``with_text`` kept, the
    remaining bytes). A null text counts as empty. Every row is a document of
    its own: repeated rows are copies and lose all they share, whatever their
    doc_id, null included. An empty table gives an empty result.
    """
    keyed = docs.select("doc_id", row_key().alias("key"), F.lit(0).cast("long").alias("ord"),
                        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    spec = Spec(span, gram, _symbols, _hashed, lambda rows: _windows(rows, span), False)
    spans = repeated(keyed, spec, store_pieces=True)
    both = keyed.join(spans, "key", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_batches(both, lambda it: _finish(it, span, with_text), schema + ", kept binary" * with_text)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), span=400)
