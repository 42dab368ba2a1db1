"""Passage deduplication against brute force, on planted and edge cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tripmart.llm import repeats, substring_dedup, suffix_dedup

SCHEMA = "doc_id long, text string, key string, start int, fp int"


def corpus() -> list[tuple]:
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghé", k=rng.randint(1, 7))) for _ in range(300)]

    def prose(n: int) -> str:
        return " ".join(rng.choices(words, k=n))

    shared, body = prose(90), prose(400)
    rows = [(i, prose(rng.randint(1, 300))) for i in range(30)]
    rows += [(100 + i, prose(40) + " " + shared + "  " + prose(30)) for i in range(6)]  # a passage with other contexts
    rows += [(200 + i, body) for i in range(3)]  # exact copies
    rows += [(300, body.replace(words[7], "zzz")), (301, "x" * 3000), (302, "ab " * 700), (303, prose(25) * 60)]
    rows += [(400, None), (401, ""), (402, "   \n"), (None, body), (403, "one"), (404, shared), (404, prose(30)),
             (405, "ß\u0000" * 500)]
    rows += [(200, body)]  # a repeated row
    rng.shuffle(rows)
    return rows


def brute_bytes(texts: list[bytes], span: int) -> list[tuple]:
    seen = Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if seen[t[i:i + span]] > 1:
                gone[i:i + span] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(bool(g) and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [repeats.SHARD_PIECES, 2])
def test_bytes_like_brute_force(spark, monkeypatch, shard):
    """With two pieces a shard, windows are merged across shards."""
    monkeypatch.setattr(repeats, "SHARD_PIECES", shard)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    found = suffix_dedup.remove_repeats(docs, span=100, gram=16).collect()
    want = brute_bytes([(t or "").encode() for _, t in rows], 100)
    key = lambda i, x: (i is None, i or 0, *x)
    assert sorted((key(r["doc_id"], tuple(r)[1:]) for r in found)) == sorted(
        key(i, x) for (i, _), x in zip(rows, want, strict=True))


def test_passages_of_over_50_words_go_from_400_bytes_on(spark):
    """The contract counts bytes: of passages that repeat across documents,
    those of 399 bytes stay, those of 400 or more go; a repeat in one document goes as well."""
    rng = random.Random(3)

    def prose(size: int) -> str:
        return " ".join("".join(rng.choices("abcdefghi", k=rng.randint(2, 6))) for _ in range(size))[:size - 1] + "x"

    rows, want = [], []
    for size in (399, 400, 401, 520):
        passage = prose(size)
        assert len(passage.encode()) == size and len(passage.split()) > 50
        for _ in range(3):
            edge = chr(ord("A") + len(rows))  # no byte before or after is shared
            rows.append((len(rows), prose(700) + edge + passage + edge + prose(700)))
            want.append((size, 1) if size >= 400 else (0, 0))
    twice = prose(450)
    rows.append((len(rows), f"{twice}Y{twice}Z"))
    want.append((900, 2))
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in suffix_dedup.remove_repeats(docs).collect())
    assert [r[2:4] for r in got] == want
    assert got == [(i, *x) for (i, _), x in zip(rows, brute_bytes([t.encode() for _, t in rows], 400), strict=True)]


def brute_words(rows: list[tuple], span: int, order) -> dict:
    first: dict = {}
    ordered = sorted(set(rows), key=order)
    for row in ordered:
        words = (row[1] or "").encode().split()
        for i in range(len(words) - span + 1):
            first.setdefault(tuple(words[i:i + span]), (row, i))
    out = {}
    for row in ordered:
        words = (row[1] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - span + 1):
            if first[tuple(words[i:i + span])] != (row, i):
                gone[i:i + span] = [True] * span
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[row] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("shard", [repeats.SHARD_PIECES, 2])
def test_words_like_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(repeats, "SHARD_PIECES", shard)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    # Rows of one id with different texts are ordered by a hash of the row.
    hashes = {(r["doc_id"], r["text"]): r["h"] for r in docs.selectExpr(
        "doc_id", "text", "xxhash64(doc_id, text) h").collect()}
    want = brute_words(rows, 20, lambda r: (-1 if r[0] is None else r[0], hashes[r]))
    found = substring_dedup.remove_passages(docs, span=20).collect()
    assert Counter((r["doc_id"], *tuple(r)[1:]) for r in found) == Counter((r[0], *want[r]) for r in rows)


def test_only_shared_windows_are_sent(spark, monkeypatch):
    """Near copies over several shards: rows that the shards exchange follow
    what the copies share, not their windows; results stay exact."""
    monkeypatch.setattr(repeats, "SHARD_PIECES", 8)
    rng = random.Random(8)
    body = "".join(rng.choices("abcdefgh", k=500))
    rows = []
    for i in range(60):  # an edit of its own in each copy
        at = rng.randrange(100, 400)
        rows.append((i, body[:at] + f"<{i:04d}>" + body[at:]))
    tables, stored = {}, repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda df, name: tables.setdefault(name, stored(df, name)))
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    got = suffix_dedup.remove_repeats(docs, span=100, gram=16).collect()
    want = brute_bytes([t.encode() for _, t in rows], 100)
    assert sorted(tuple(r) for r in got) == sorted((i, *x) for (i, _), x in zip(rows, want, strict=True))
    found = tables["found"]
    pieces, filters = found.where("body is not null"), found.where("hashes is not null")
    assert pieces.count() > 8 and filters.count() > 1
    assert pieces.groupBy("fp", "ph").count().where("count > 1").count() == 0
    assert filters.selectExpr("sum(length(hashes) / 4)").first()[0] <= pieces.selectExpr("sum(n)").first()[0]


def test_window_hashes_follow_windows():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 3, 300).astype(np.uint64)
    for span in (1, 2, 3, 7, 20, 64, 100):
        hashes = repeats.window_hashes(text * np.uint64(0x9E3779B97F4A7C15), span)
        windows = [text[i:i + span].tobytes() for i in range(300 - span + 1)]
        assert len(hashes) == len(windows)
        assert len(set(zip(windows, hashes.tolist(), strict=True))) == len(set(windows)) == len(set(hashes.tolist()))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.remove_repeats(docs).count() == 0
    assert substring_dedup.remove_passages(docs).count() == 0


def test_suffix_array_and_prefixes_match_sorting():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    text[200:260] = text[100:160]
    end = np.repeat([150, 400], [150, 250])
    sa, rank = suffix_dedup.suffix_array(text, end, 50)
    cut = [bytes(text[i:min(end[i], i + 56)]) for i in range(400)]
    assert [cut[i] for i in sa] == sorted(cut)
    shared = suffix_dedup.common_prefixes(text, end, sa, rank, 50)
    for a, b in zip(sa[:-1], sa[1:], strict=True):
        n = next((k for k in range(50) if k >= min(len(cut[a]), len(cut[b])) or cut[a][k] != cut[b][k]), 50)
        assert shared[b] == n


def test_fm_index_counts_patterns():
    rng = np.random.default_rng(2)
    text = np.r_[rng.integers(1, 6, 500), 0]
    index = substring_dedup.FMIndex(text, 6, 32)
    for n in (1, 2, 3, 8):
        for at in rng.integers(0, 490, 20):
            low, high = np.array([0]), np.array([len(text)])
            for symbol in text[at:at + n][::-1]:
                low, high = index.prepend(np.array([symbol]), low, high)
            want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == text[at:at + n]).all()]
            assert sorted(index.sa[low[0]:high[0]]) == want


def test_word_hashes_follow_words():
    texts = [b"a bb  a", b"", b"\tbb\n", "é a".encode(), b"x" * 50]
    hashes, counts = substring_dedup.word_hashes(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    by = {}
    for w, h in zip([w for t in texts for w in t.split()], hashes.tolist(), strict=True):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


def test_short_patterns_start_the_search():
    rng = np.random.default_rng(3)
    text = np.r_[rng.integers(1, 4, 300), 0, rng.integers(1, 4, 40), 0]
    index = substring_dedup.FMIndex(text, 4, 32)
    low, high = index.short(text, 5)
    for at in [*range(296), *range(301, 337)]:
        one, last = np.zeros(1, np.int64), np.full(1, len(text))
        for symbol in text[at:at + 5][::-1]:
            one, last = index.prepend(np.array([symbol]), one, last)
        assert (low[at], high[at]) == (one[0], last[0])


def test_files_counted_without_pieces():
    import pandas as pd

    texts = [(t or "").encode() for _, t in corpus()]
    spec = repeats.Spec(20, 4, substring_dedup.word_hashes, substring_dedup._hashed, None, True)
    batch = pd.DataFrame({"text": texts, "key": range(len(texts)), "ord": 0})
    pieces, files = (pd.concat(f([batch], spec)) for f in (repeats._pieces, repeats._files))
    wanted = pieces.groupby("fp").agg(c=("key", "size"), inner=("inner", "max"))
    assert files.groupby("fp").agg(c=("c", "sum"), inner=("inner", "max")).equals(wanted)
    assert len(files) < len(pieces)
