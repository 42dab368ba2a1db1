"""Removal of passages that occur earlier, with an FM-index per shard.

Documents are cut into pieces of words (see ``repeats``). A shard's pieces
are kept as an FM-index: the Burrows-Wheeler transform of their words in a
wavelet matrix of packed bits. The shard's pieces are streamed through it:
backward search extends every window word by word as long as it occurs
elsewhere (its matching statistic), and windows that reach the threshold
report their suffix-array interval, whose smallest position is the first
occurrence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents, map_batches, row_key
from tripmart.llm.repeats import Spec, _groups, mix, removal, repeated
from tripmart.llm.suffix_dedup import refine

_BYTE = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x2545F4914F6CDD1D
_POWERS: dict[str, np.ndarray] = {}
#: Words of the patterns whose intervals are read from the suffix array; backward search starts there.
SHORT = 8


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = 1 << max(21, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            power, factor = np.ones(1, np.uint64), base
            while len(power) < size:
                power, factor = np.concatenate([power, power * np.uint64(factor)]), factor * factor % (1 << 64)
            _POWERS[name] = power
    return _POWERS["up"], _POWERS["down"]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the number of words of each text."""
    joined = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    n = len(joined)
    blank = _SPACE[joined]
    edge = np.flatnonzero(np.diff(np.r_[True, blank, True].view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    up, down = _powers(n)
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(_BYTE[joined] * up[:n])]
    words = mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
    size = np.array([len(t) + 1 for t in texts], np.int64)
    return words, np.diff(np.searchsorted(begin, np.r_[0, np.cumsum(size)]))


#: The bits of a word below each of its positions.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class Wavelet:
    """Wavelet matrix: rank of any symbol, 64 positions to a packed word."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.levels, n = [], len(text)
        self.number = np.int32 if n < 1 << 31 else np.int64
        for bit in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            one = (text >> bit) & 1 == 1
            packed = np.packbits(np.r_[one, np.zeros(-n % 64 + 64, bool)], bitorder="little").view("<u8")
            before = np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]].astype(self.number)
            self.levels.append((bit, packed, before, n - int(one.sum())))
            text = np.concatenate([text[~one], text[one]])
        every = np.arange(symbols)
        self.base = np.zeros(symbols, self.number)
        self.base = self.rank(every, np.zeros(symbols, np.int64))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at`` (one or more rows of positions)."""
        start, at = self.base[symbol], at.astype(self.number)
        for bit, packed, before, zeros in self.levels:
            block = at >> 6
            ones = before[block] + np.bitwise_count(packed[block] & _BELOW[at & 63])
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at - start


class FMIndex:
    """FM-index of pieces of words; exact for patterns shorter than ``depth``.

    ``text`` has symbols from 1 up and a 0 after each piece.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        n = len(text)
        self.sa = np.argsort(text, kind="stable")
        order = text[self.sa]
        refine(self.sa, np.r_[True, order[1:] != order[:-1]], np.full(n, n), 1, depth)
        self.wavelet = Wavelet(text[self.sa - 1], symbols)
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))]

    def short(self, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the ``size`` symbols from each position on, by position
        (of patterns within a piece, shorter than ``depth``)."""
        n = len(text)
        padded, new = np.r_[text, np.zeros(size, text.dtype)], np.zeros(n, bool)
        new[0] = True
        for t in range(size):
            symbol = padded[self.sa + t]
            new[1:] |= symbol[1:] != symbol[:-1]
        begin = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        at = np.empty(n, np.int64)
        at[self.sa] = group
        return begin[at], np.r_[begin[1:], n][at]

    def prepend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front."""
        low, high = self.first[symbol] + self.wavelet.rank(symbol, np.stack([low, high]))
        return low, high


def _windows(rows: pd.DataFrame, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows with an earlier occurrence in the block (rows are in document
    order), and those without."""
    n = rows["n"].to_numpy().astype(np.int64)
    words = np.frombuffer(b"".join(rows["body"]), np.uint64)
    size = n + span - 1
    kinds, code = np.unique(words, return_inverse=True)
    piece = np.repeat(np.arange(len(rows)), size)
    text = np.zeros(len(words) + len(rows), np.int64)
    place = np.arange(len(words)) + piece
    text[place] = code + 1
    index = FMIndex(text, len(kinds) + 1, 1 << span.bit_length())
    window = place[(np.repeat(np.cumsum(size), size) - np.arange(len(words))) >= span]
    earlier, known = np.zeros(len(window), bool), min(SHORT, span)
    low, high = (x[window + span - known] for x in index.short(text, known))
    live = np.flatnonzero(high - low > 1)
    low, high = low[live], high[live]
    for t in range(span - known - 1, -1, -1):
        low, high = index.prepend(text[window[live] + t], low, high)
        more = high - low > 1  # else only the window itself
        live, low, high = live[more], low[more], high[more]
    if len(live):
        left, first = np.unique(low, return_index=True)
        right = high[first]
        bounds = np.stack([left, right], axis=1).ravel()
        least = np.minimum.reduceat(np.r_[index.sa, len(text)], bounds)[::2]
        earlier[live] = least[np.searchsorted(left, low)] < window[live]
    return earlier, ~earlier


def _hashed(symbols: np.ndarray) -> np.ndarray:
    return symbols


def _finish(batches: Iterator[pd.DataFrame], span: int, with_text: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for rows in _groups([len(t) for t in batch["text"]], 64 << 20):
            part, out = batch.iloc[rows], []
            for text, spans in zip(part["text"], part["spans"], strict=True):
                words, removed = text.split(), 0
                n = len(words)
                if spans is not None and len(spans):
                    gone = removal(spans, n, span)
                    removed = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                kept = b" ".join(words)
                out.append((n, removed, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            done = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept"])
            done.insert(0, "doc_id", part["doc_id"].astype("Int64").to_numpy())
            yield done if with_text else done.drop(columns="kept")


def remove_passages(docs: DataFrame, span: int = 20, gram: int = 4, with_text: bool = False) -> DataFrame:
    """Remove every word covered by a ``span``-word window that starts earlier.

    ``docs``: doc_id, text; other columns are ignored. Returns doc_id,
    n_words, n_removed, kept_sha256 (and with ``with_text`` kept). Documents
    are ordered by doc_id, nulls first; rows of one doc_id with different
    texts by a hash of the text. Rows equal in doc_id and text are one
    document and get the same result. A null text has no words. An empty
    table gives an empty result.
    """
    first = F.coalesce("doc_id", F.lit(-(1 << 63)))
    keyed = docs.select("doc_id", row_key().alias("key"), first.alias("ord"),
                        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    spec = Spec(span, gram, word_hashes, _hashed, lambda rows: _windows(rows, span), True)
    spans = repeated(keyed, spec, store_pieces=False)
    both = keyed.join(spans, "key", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return map_batches(both, lambda it: _finish(it, span, with_text), schema + ", kept string" * with_text)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_passages(documents(spark, sf_dir), span=20)


#: A window's start is earlier if another equal window comes first in order.
OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 19], ' ')) AS d
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)
), gone AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY d ORDER BY doc_id, i) AS r FROM s) WHERE r > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM gone
), every AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM w
), kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) FILTER (WHERE c.i IS NULL) AS t, count(c.i) AS n_removed
  FROM every e LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.i = e.i GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
