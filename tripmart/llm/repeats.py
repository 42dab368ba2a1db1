"""What the two passage-deduplication operators share.

Both look for windows of ``span`` symbols (bytes or words) that occur more
than once. A window is filed under the smallest hash of the grams inside it,
so equal windows have the same file number, and consecutive windows of a
document mostly share one. A run of such windows is a *piece*: a stretch of
the document. Only file numbers that occur twice, or whose piece has a
period, can hold a repeat. Equal
pieces are counted, not repeated; of each different piece one copy goes to
the index shard of its file number, where the operator's own index finds the
repeated windows. A file number with more pieces than a shard may hold is
dealt to several shards. Those first exchange 32-bit filters of their windows,
packed and cut into slices; only windows that another shard may hold as well
then send a digest, and the digests are merged in sorted order.

Positions count symbols from the start of a document. Every step is exact:
no window is dropped, and hashes have at least 128 bits in all where equality
follows from them (file number and content hash of a piece, or a window's
digest).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import map_batches, shuffle_width, stored

#: Symbols hashed at once, longest piece in windows, pieces of one shard, and
#: symbols a task indexes at once.
SLICE, RUN, SHARD_PIECES, BLOCK = 1 << 21, 512, 4096, 1 << 20
GROUP_BYTES = 1 << 20
KEY = ["fp", "ph"]
FOUND = ["fp", "ph", "lo", "hi", "salt", "salts", "ord", "key", "start", "n", "body", "stands", "part", "hashes"]


@dataclass(frozen=True)
class Spec:
    span: int
    gram: int
    #: Texts to their symbols one after the other, and how many each has.
    symbols: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    #: Symbols to 64-bit hashes.
    hashed: Callable[[np.ndarray], np.ndarray]
    #: A block of pieces to its repeated windows (see _index).
    index: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]]
    #: Whether the first occurrence of a window stays.
    keep_first: bool


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(h: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` consecutive symbols (gram: a power of two)."""
    factor, size = 0x9E3779B97F4A7C15, 1
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor, size = factor * factor % (1 << 64), size * 2
    return mix(h)


def window_hashes(h: np.ndarray, span: int) -> np.ndarray:
    """Hash of every ``span`` consecutive symbols, for any ``span``: runs of
    1, 2, 4, ... symbols, put together by the binary digits of ``span``."""
    factor, size, done, out = 0x9E3779B97F4A7C15, 1, 0, None
    n = len(h) - span + 1
    while True:
        if span & size:
            part = h[done:done + n]
            out = part.copy() if out is None else out * np.uint64(factor) + part
            done += size
        if 2 * size > span:
            return mix(out)
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor, size = factor * factor % (1 << 64), size * 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def winnow(h: np.ndarray, room: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Pieces: first window, number of windows, file number, and whether a
    window may occur twice inside the piece.

    ``room``: symbols from a position to the end of its document. Equal
    windows s < s + d in a piece make the text between periodic, so the
    smallest gram starts one of the windows before s + d and the next window
    has it again: a window that starts with its smallest gram and is followed
    by one filed alike gives the piece away.
    """
    found = []
    for a in range(0, max(0, len(h) - span + 1), SLICE):
        grams = gram_hashes(h[a:a + SLICE + span - 1], gram)
        low = sliding_min(grams, span - gram + 1)
        at = np.flatnonzero(room[a:a + len(low)] >= span)
        if not len(at):
            continue
        leads = np.r_[0, np.cumsum(grams[at] == low[at])]
        low = low[at]
        first = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)])
        n = np.diff(np.r_[first, len(at)])
        parts = -(-n // RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, n = np.repeat(first, parts) + nth * RUN, np.repeat(n, parts) - nth * RUN
        n = np.minimum(n, RUN)
        found.append((at[first] + a, n, low[first], leads[first + n - 1] > leads[first]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _groups(sizes: list[int], limit: int) -> Iterator[slice]:
    """Consecutive rows of about ``limit`` in size."""
    begin = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= limit:
            yield slice(begin, i + 1)
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def _pieces(batches: Iterator[pd.DataFrame], spec: Spec) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [t or b"" for t in batch["text"]]
        for rows in _groups([len(t) for t in texts], GROUP_BYTES):
            symbols, counts = spec.symbols(texts[rows])
            end = np.cumsum(counts)
            room = np.repeat(end, counts) - np.arange(len(symbols))
            at, n, fp, inner = winnow(spec.hashed(symbols), room, spec.span, spec.gram)
            doc = np.searchsorted(end, at, "right")
            view, size = memoryview(symbols).cast("B"), symbols.itemsize
            ph = [xxhash.xxh3_64_intdigest(view[a * size:b * size])
                  for a, b in zip(at.tolist(), (at + n + spec.span - 1).tolist(), strict=True)]
            yield pd.DataFrame({
                "key": batch["key"].to_numpy()[rows][doc], "ord": batch["ord"].to_numpy()[rows][doc],
                "fp": fp.view(np.int64), "ph": np.array(ph, np.uint64).view(np.int64),
                "start": at - (end - counts)[doc], "n": n.astype(np.int32), "inner": inner})


def _files(batches: Iterator[pd.DataFrame], spec: Spec) -> Iterator[pd.DataFrame]:
    """What _pieces says of file numbers: of each, the pieces, and whether one has a period."""
    for batch in batches:
        texts = [t or b"" for t in batch["text"]]
        for rows in _groups([len(t) for t in texts], GROUP_BYTES):
            symbols, counts = spec.symbols(texts[rows])
            room = np.repeat(np.cumsum(counts), counts) - np.arange(len(symbols))
            _, _, fp, inner = winnow(spec.hashed(symbols), room, spec.span, spec.gram)
            kinds, which, c = np.unique(fp, return_inverse=True, return_counts=True)
            yield pd.DataFrame({"fp": kinds.view(np.int64), "c": c.astype(np.int64),
                                "inner": np.bincount(which[inner], minlength=len(kinds)) > 0})


def _bodies(batches: Iterator[pd.DataFrame], spec: Spec) -> Iterator[pd.DataFrame]:
    """The symbols of the pieces asked for, from their documents."""
    for batch in batches:
        for rows in _groups([len(t) for t in batch["text"]], 4 * GROUP_BYTES):
            part = batch.iloc[rows]
            symbols, counts = spec.symbols(list(part["text"]))
            base, out = np.cumsum(counts) - counts, []
            for b, key, order, asked in zip(base.tolist(), part["key"], part["ord"], part["asked"], strict=True):
                for r in asked:
                    a = b + r["start"]
                    out.append((r["fp"], r["ph"], r["salt"], r["salts"], order, key, r["start"], r["n"],
                                symbols[a:a + r["n"] + spec.span - 1].tobytes()))
            yield pd.DataFrame(out, columns=["fp", "ph", "salt", "salts", "ord", "key", "start", "n", "body"])


def _runs(hit: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive windows of one piece."""
    if not len(hit):
        return hit, hit
    edge = np.r_[True, (np.diff(hit) > 1) | (np.diff(row[hit]) != 0)]
    return hit[edge], hit[np.r_[edge[1:], True]]


def _filter_hashes(rows: pd.DataFrame, n: np.ndarray, spec: Spec) -> np.ndarray:
    """Hash of every window of the pieces, in order of rows."""
    size = n + spec.span - 1
    body = b"".join(rows["body"])
    symbols = np.frombuffer(body, np.dtype(f"u{len(body) // int(size.sum())}"))
    end = np.repeat(np.cumsum(size), size)
    inside = np.flatnonzero(end - np.arange(len(symbols)) >= spec.span)
    return window_hashes(spec.hashed(symbols), spec.span)[inside]


def _index(batches: Iterator[pd.DataFrame], spec: Spec) -> Iterator[pd.DataFrame]:
    """Index blocks of whole shards, rows sorted by (fp, salt).

    ``spec.index`` returns, for the windows of a block in order of its rows,
    whether each is to be removed, and whether it stands for its equals in
    the block. Rows out: removed windows [lo, hi) of a piece; and, for file
    numbers with several shards, the pieces themselves, a bit a window for
    those that stand for their equals, and each shard's filter, a row a
    slice: 32 bits of each different window.
    """
    held: list[pd.DataFrame] = []

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(KEY).sort_values(["ord", "key", "start"], ignore_index=True)
        removed, stands = spec.index(rows)
        n = rows["n"].to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        first, last = _runs(np.flatnonzero(removed), row)
        out = [rows[KEY].iloc[row[first]].assign(lo=at[first], hi=at[last] + 1)]
        split = (rows["salts"] > 1).to_numpy()
        if split.any():
            end = np.cumsum(n)
            bits = [np.packbits(stands[e - k:e]).tobytes() for e, k in zip(end[split], n[split], strict=True)]
            out.append(rows.loc[split, [*KEY, "salt", "salts", "ord", "key", "start", "n", "body"]].assign(stands=bits))
            sent = stands[split[row]]
            of, rows, n = row[split[row]][sent], rows[split], n[split]
            hashes = _filter_hashes(rows, n, spec)[sent]
            of = (np.cumsum(split) - 1)[of]
            shard = pd.DataFrame({c: rows[c].to_numpy()[of] for c in ("fp", "salt")})
            shard["part"] = ((hashes >> np.uint64(32)) % rows["salts"].to_numpy().astype(np.uint64)[of]).astype(np.int32)
            low = hashes.astype(np.uint32)
            filters = [(*key, np.unique(low[which]).tobytes())
                       for key, which in shard.groupby(["fp", "salt", "part"]).indices.items()]
            out.append(pd.DataFrame(filters, columns=["fp", "salt", "part", "hashes"]))
        types = {c: object if c in ("body", "stands", "hashes") else "Int64" for c in FOUND}
        done = pd.concat([o.reindex(columns=FOUND).astype(types) for o in out], ignore_index=True)
        for c in ("body", "stands", "hashes"):
            done[c] = done[c].where(done[c].notna(), None)
        return done

    for batch in batches:
        held.append(batch)
        if sum(int(b["n"].sum()) + spec.span * len(b) for b in held) >= BLOCK:
            rows = pd.concat(held, ignore_index=True)
            group = ((rows["fp"] != rows["fp"].shift()) | (rows["salt"] != rows["salt"].shift())).cumsum().to_numpy()
            cost = np.cumsum(rows["n"].to_numpy() + spec.span)
            begin = 0
            while True:  # whole shards, about BLOCK symbols at a time
                cut = np.searchsorted(cost, (cost[begin - 1] if begin else 0) + BLOCK)
                cut = np.searchsorted(group, group[cut], "left") if cut < len(rows) else len(rows)
                if cut <= begin:  # one shard fills the block
                    cut = np.searchsorted(group, group[begin], "right")
                if cut >= len(rows):
                    break
                yield solve(rows.iloc[begin:cut])
                begin = cut
            held = [rows.iloc[begin:]]
    if held and sum(map(len, held)):
        yield solve(pd.concat(held, ignore_index=True))


def _shared(filters: pd.DataFrame) -> pd.DataFrame:
    """One slice of one file number: what of each shard's filter another holds too."""
    lists = [np.frombuffer(h, np.uint32) for h in filters["hashes"]]
    values, shards = np.unique(np.concatenate(lists), return_counts=True)
    values = values[shards > 1]
    both = [values[np.isin(values, own, assume_unique=True)].tobytes() for own in lists]
    out = filters[["fp", "salt", "part"]].assign(hashes=both)
    return out[out["hashes"].str.len() > 0]


def _digests(pieces: pd.DataFrame, shared: pd.DataFrame, spec: Spec) -> pd.DataFrame:
    """The different windows of one shard that its shared filter lets through, with digests."""
    columns = ["fp", "ph", "ord", "key", "start", "lo", "hi", "digest"]
    if not len(pieces) or not len(shared):
        return pd.DataFrame(columns=columns)
    n = pieces["n"].to_numpy().astype(np.int64)
    hashes = _filter_hashes(pieces, n, spec)
    row = np.repeat(np.arange(len(pieces)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    part, low = (hashes >> np.uint64(32)) % np.uint64(pieces["salts"].iloc[0]), hashes.astype(np.uint32)
    sent = np.zeros(len(row), bool)
    for p, known in zip(shared["part"].tolist(), shared["hashes"], strict=True):
        mine = np.flatnonzero(part == np.uint64(p))
        sent[mine] = np.isin(low[mine], np.frombuffer(known, np.uint32))
    sent &= np.concatenate([np.unpackbits(np.frombuffer(bits, np.uint8), count=k).astype(bool)
                            for bits, k in zip(pieces["stands"], n.tolist(), strict=True)])
    row, at = row[sent], at[sent]
    body = pieces["body"].tolist()
    size = len(body[0]) // (int(n[0]) + spec.span - 1)
    out = pieces[["fp", "ph", "ord", "key", "start"]].iloc[row].reset_index(drop=True)
    return out.assign(lo=at, hi=at + 1, digest=[
        xxhash.xxh3_128_digest(memoryview(body[r])[a * size:(a + spec.span) * size])
        for r, a in zip(row.tolist(), at.tolist(), strict=True)])


def _merge(batches: Iterator[pd.DataFrame], keep_first: bool) -> Iterator[pd.DataFrame]:
    """Merge the shards' windows, sorted by digest, then document order.

    Binary search of each digest in the merged order tells how often it
    occurs. The last digest's rows wait for the next batch.
    """
    held = None
    columns = ["fp", "ph", "lo", "hi"]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        order = np.array([int.from_bytes(d[:8], "big") for d in rows["digest"]], np.uint64)
        whole = rows["digest"].to_numpy()
        low, high = np.searchsorted(order, order, "left"), np.searchsorted(order, order, "right")
        same = np.array([whole[a] == whole[b - 1] for a, b in zip(low, high, strict=True)], bool)
        if not same.all():  # digests that share their first half
            text = rows["digest"].astype("S16").to_numpy()
            low, high = np.searchsorted(text, text, "left"), np.searchsorted(text, text, "right")
        gone = (low < np.arange(len(rows))) if keep_first else (high - low > 1)
        return rows.loc[gone, columns]

    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        open_rows = (rows["digest"] == rows["digest"].iloc[-1]).to_numpy()
        held = rows[open_rows]
        if not open_rows.all():
            yield solve(rows[~open_rows].reset_index(drop=True))
    if held is not None and len(held):
        yield solve(held.reset_index(drop=True))


def repeated(docs: DataFrame, spec: Spec, store_pieces: bool) -> DataFrame:
    """key and spans: windows [begin, end) to remove, as begin << 32 | end.

    ``docs``: key, ord (document order), text (bytes); rows of one key are
    equal. A window is to be removed if it occurs again anywhere, or with
    ``keep_first`` if it occurs earlier by (ord, key, start).
    """
    n = shuffle_width(docs.sparkSession)
    pieces = map_batches(docs.select("key", "ord", "text"), lambda it: _pieces(it, spec),
                         "key long, ord long, fp long, ph long, start long, n int, inner boolean")
    if store_pieces:
        pieces = stored(pieces, "pieces")
        files = pieces.select("fp", F.lit(1).cast("long").alias("c"), "inner")
    else:  # pieces are made twice, but hashed and sent only once
        files = map_batches(docs.select("text"), lambda it: _files(it, spec), "fp long, c long, inner boolean")
    twice = files.groupBy("fp").agg(F.sum("c").alias("c"), F.max("inner").alias("inner")).where(
        "c > 1 or inner").select("fp")
    pieces = stored(pieces.join(twice, "fp"), "repeated")
    place = F.struct("ord", "key", "start")
    kinds = stored(pieces.groupBy(*KEY).agg(F.count("*").alias("copies"), F.min(place).alias("first"),
                                            F.first("n").alias("n"), F.max("inner").alias("inner")), "kinds")
    salts = kinds.groupBy("fp").agg(F.count("*").alias("kinds"), F.max("inner").alias("inner")).where(
        "kinds > 1 or inner").select(
        "fp", F.ceil(F.col("kinds") / SHARD_PIECES).cast("int").alias("salts"))
    asked = (kinds.join(salts, "fp").withColumn("salt", F.pmod(F.xxhash64("ph"), F.col("salts")).cast("int"))
             .groupBy(F.col("first.key").alias("key"))
             .agg(F.collect_list(F.struct("fp", "ph", "salt", "salts", F.col("first.start").alias("start"), "n"))
                  .alias("asked")))
    bodies = map_batches(docs.join(asked, "key").select("key", "ord", "text", "asked"), lambda it: _bodies(it, spec),
                         "fp long, ph long, salt int, salts int, ord long, key long, start long, n int, body binary")
    shards = bodies.repartition(n, "fp", "salt").sortWithinPartitions("fp", "salt")
    found = stored(map_batches(shards, lambda it: _index(it, spec), "fp long, ph long, lo int, hi int, salt int, "
                               "salts int, ord long, key long, start long, n int, body binary, stands binary, part int, "
                               "hashes binary"), "found")
    shared = found.where("hashes is not null").select("fp", "salt", "part", "hashes").groupBy(
        "fp", "part").applyInPandas(_shared, "fp long, salt int, part int, hashes binary")
    split = found.where("body is not null").drop("lo", "hi", "part", "hashes")
    sent = split.groupBy("fp", "salt").cogroup(shared.groupBy("fp", "salt")).applyInPandas(
        lambda a, b: _digests(a, b, spec),
        "fp long, ph long, ord long, key long, start long, lo int, hi int, digest binary")
    merged = sent.repartition(n, "digest").sortWithinPartitions("digest", "ord", "key", F.col("start") + F.col("lo"))
    keep_first = spec.keep_first
    across = map_batches(merged, lambda it: _merge(it, keep_first), "fp long, ph long, lo int, hi int")
    inside = (found.where("lo is not null").select("fp", "ph", "lo", "hi").unionByName(across)
              .groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("runs")))
    told = kinds.join(inside, KEY, "left").where("copies > 1 or runs is not null")
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi")))
    runs = F.coalesce("runs", F.array().cast("array<struct<lo:int,hi:int>>"))
    own = (F.col("key") == F.col("first.key")) & (F.col("start") == F.col("first.start"))
    if keep_first:
        runs = F.when(own, runs).otherwise(whole)
    else:
        runs = F.when(F.col("copies") > 1, whole).otherwise(runs)
    span = F.transform(runs, lambda r: F.shiftleft(F.col("start") + r["lo"], 32).bitwiseOR(F.col("start") + r["hi"]))
    spans = pieces.select("key", "start", *KEY).join(told, KEY).select("key", span.alias("spans")).where("size(spans) > 0")
    return spans.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def removal(spans, n: int, span: int) -> np.ndarray:
    """Mask of the symbols covered by the windows in ``spans``."""
    packed = np.asarray(spans, np.int64)
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, packed >> 32, 1)
    np.add.at(change, (packed & 0xFFFFFFFF) + span - 1, -1)
    return np.cumsum(change[:-1]) > 0
