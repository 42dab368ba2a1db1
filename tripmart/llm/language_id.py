"""Language identification with a string kernel.

A text is the set of its character n-grams of 1 to ``max_n`` letters (the
blended spectrum, by presence), after lower-casing; the kernel of two texts
is the size of the common set over the geometric mean of both sizes. Kernel
ridge regression, one model a language against the rest, is solved on
Nyström landmarks. It is fitted on a bounded sample on the driver; every
document is then scored in batches: the matrix of n-gram presence times the
landmarks' presence matrix times the coefficients. The last two factors are
the same for all documents and are multiplied once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import documents, map_batches, stored

#: n-grams are numbered by a hash of so many bits.
BITS = 20
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
#: Characters of a very long text taken at once.
SLICE = 1 << 18
#: Texts scored at once, and their characters (a longer text is scored alone).
BATCH_ROWS, BATCH_CHARS = 256, 1 << 18


def grams(text: str, max_n: int, stamp: np.ndarray) -> np.ndarray:
    """Distinct n-gram numbers of a text; ``stamp`` is scratch space."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found = []
    for at in range(0, len(chars), SLICE):
        part = chars[at:at + SLICE + max_n - 1]
        code, codes = np.zeros(len(part) + 1, np.uint64), []
        for n in range(1, max_n + 1):
            if len(part) < n:
                break
            code = code[:len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1:] + np.uint64(n)
            codes.append(((code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS))
        every = np.concatenate(codes).astype(np.int64)
        order = np.arange(len(every), dtype=np.int32)
        stamp[every] = order
        found.append(every[stamp[every] == order])
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


@dataclass
class Model:
    languages: list[str]
    row: np.ndarray  # of each n-gram number; 0 for n-grams of no landmark
    weights: np.ndarray  # landmarks' presence times coefficients, by row
    max_n: int


def fit(texts: list[str], languages: list[str], landmarks: int, max_n: int, ridge: float) -> Model:
    """Kernel ridge regression on Nyström landmarks, one against the rest."""
    names, stamp = sorted(set(languages)), np.zeros(1 << BITS, np.int32)
    sets = [grams(t, max_n, stamp) for t in texts]
    by = {name: [i for i, x in enumerate(languages) if x == name] for name in names}
    turn = [i for k in range(len(texts)) for name in names if k < len(by[name]) for i in by[name][k:k + 1]]
    marks = turn[:landmarks]
    vocabulary = np.unique(np.concatenate([sets[i] for i in marks])) if marks else np.empty(0, np.int64)
    row = np.zeros(1 << BITS, np.int32)
    row[vocabulary] = np.arange(1, len(vocabulary) + 1)
    presence = np.zeros((len(vocabulary) + 1, len(marks)), np.float32)
    for k, i in enumerate(marks):
        presence[row[sets[i]], k] = 1 / np.sqrt(max(1, len(sets[i])))
    kernel = np.stack([presence[row[s]].sum(axis=0) / np.sqrt(max(1, len(s))) for s in sets]).astype(np.float64)
    wanted = np.array([[1.0 if x == name else -1.0 for name in names] for x in languages])
    balance = np.array([1 / len(by[x]) for x in languages]) * len(texts) / len(names)
    inner = kernel[marks]
    left = kernel.T @ (kernel * balance[:, None]) + ridge * (inner + inner.T) / 2 + 1e-8 * np.eye(len(marks))
    alpha = np.linalg.solve(left, kernel.T @ (wanted * balance[:, None]))
    weights = (presence @ alpha).astype(np.float32)
    weights[0] = 0
    return Model(names, row, weights, max_n)


def predict(model: Model | None, texts: list[str | None], stamp: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; a batch is one matrix product."""
    known = [bool(t and LETTER.search(t)) and model is not None for t in texts]
    rows, sizes = [], []
    for text, ok in zip(texts, known, strict=True):
        found = grams(text, model.max_n, stamp) if ok else np.empty(0, np.int64)
        rows.append(np.r_[0, model.row[found]] if ok else np.zeros(1, np.int64))
        sizes.append(max(1, len(found)))
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    begin = np.cumsum([0] + [len(r) for r in rows])[:-1]
    total = np.add.reduceat(model.weights[np.concatenate(rows)], begin, axis=0) / np.sqrt(sizes)[:, None]
    best = total.argmax(axis=1)
    score = np.clip((total[np.arange(len(texts)), best] + 1) / 2, 0, 1) * known
    return [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)], score


def _portions(sizes: list[int]) -> Iterator[slice]:
    """Consecutive texts of BATCH_ROWS rows and BATCH_CHARS characters at most."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and (i - begin >= BATCH_ROWS or total + n > BATCH_CHARS):
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def _scored(batches: Iterator[pd.DataFrame], model, pred: str, score: str) -> Iterator[pd.DataFrame]:
    stamp = np.zeros(1 << BITS, np.int32)
    for batch in batches:
        texts = [t if isinstance(t, str) else None for t in batch["text"]]
        for rows in _portions([len(t or "") for t in texts]):
            found, scores = predict(model.value, texts[rows], stamp)
            yield batch.iloc[rows].assign(**{pred: found, score: scores})


def held_out(doc_id) -> F.Column:
    """Whether a document is kept out of the training rows."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, sample_rows: int = 2000, per_language: int = 400, max_chars: int = 20_000,
          landmarks: int = 240, max_n: int = 4, ridge: float = 0.1) -> Model | None:
    """Fit on a sample of at most ``sample_rows`` labelled texts.

    Documents held out or without lang are no training rows. A language gives
    up to ``per_language`` different texts, fewer if there are many
    languages, chosen by a hash of the text; copies of a text count once.
    Texts longer than ``max_chars`` are passed over where the language has
    shorter ones; else its shortest text is taken whole. None if there are no
    training rows.
    """
    n = F.length("text")
    rows = docs.select("lang", "text", F.when(n > max_chars, n).otherwise(0).alias("over"),
                       F.xxhash64("text", F.lit(7)).alias("draw")).where(
        F.col("lang").isNotNull() & (n > 0) & ~held_out(F.col("doc_id")))
    kinds = stored(rows.select("lang", "over", "draw").distinct(), "draws")
    languages = kinds.groupBy("lang").agg(F.count("*").alias("texts")).orderBy(F.desc("texts"), "lang").limit(sample_rows)
    names = [r["lang"] for r in languages.collect()]
    if not names:
        return None
    each = max(1, min(per_language, sample_rows // len(names)))
    # The first of each language by hash: tasks pass on no more than that.
    ranked = kinds.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("over", "draw")))
    chosen = ranked.where(F.col("place") <= each).where("over = 0 OR place = 1").join(
        F.broadcast(languages.select("lang")), "lang").select("lang", "draw")  # sample_rows rows at most
    taken = (rows.join(F.broadcast(chosen), ["lang", "draw"]).groupBy("lang", "draw")
             .agg(F.min("text").alias("text")).orderBy("draw", "lang").collect())
    return fit([r["text"] for r in taken], [r["lang"] for r in taken], landmarks, max_n, ridge)


def identify(docs: DataFrame, model: Model | None, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with ``pred`` and ``score`` (columns of those names are replaced).

    Only the text is read. ``und`` with score 0 for a null text, one without
    a letter, or if there is no model. Every row, repeated or not, is scored
    on its own; an empty table gives no rows.
    """
    keep = docs.drop(pred, score)
    given = docs.sparkSession.sparkContext.broadcast(model)
    out = [f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema]
    return map_batches(keep, lambda it: _scored(it, given, pred, score),
                       ", ".join([*out, f"`{pred}` string", f"`{score}` double"]))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
