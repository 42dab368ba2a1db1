"""Decontamination, nearest neighbours, the pipeline and the registry."""

from __future__ import annotations

import glob
import os
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tripmart.llm import decontamination, nn_descent
from tripmart.llm.common import batch_rows
from tripmart.llm.components import components
from tripmart.session import scratch_dir

DOCS = "doc_id long, text string, item_id int, m int, key int"


def shingle_counts(words):
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])


def brute_contaminated(docs, items):
    out = {}
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    for item_id, text in items:
        b = words(text)
        for doc_id, t in docs if b else []:
            a = words(t)
            n = min(len(a), len(b))
            for s in range(len(a) - n + 1) if a else []:
                x, y = shingle_counts(a[s:s + n]), shingle_counts(b)
                both = sum((x & y).values())
                sim = both / (sum(x.values()) + sum(y.values()) - both)
                if sim >= 0.8:
                    out[doc_id, item_id] = max(sim, out.get((doc_id, item_id), 0))
    return out


def test_contaminated_like_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdef", k=4)) for _ in range(80)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, prose(n)) for i, n in enumerate([12, 30, 30, 45, 60, 3, 5])] + [(20, None), (21, "!!"), (22, "a " * 40)]
    items.append((23, items[1][1]))  # an item twice
    docs = []
    for k, (_, t) in enumerate(items[:7]):
        w = t.split()
        docs.append((100 + k, prose(30) + ". " + t.upper() + "! " + prose(20)))
        for cuts in (1, 2, 3):
            v = list(w)
            for at in rng.sample(range(len(v)), min(cuts, len(v))):
                v[at] = "zz"
            docs.append((200 + 10 * k + cuts, prose(8) + " " + " ".join(v) + " " + prose(9)))
        docs.append((300 + k, " ".join(w[1:])))  # shorter than the item
    docs += [(i, prose(60)) for i in range(10)] + [(50, None), (51, ""), (52, "a " * 300), (53, items[1][1] + " " + items[1][1])]
    docs += [docs[0], (54, items[2][1]), (54, prose(9))]
    frame = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], DOCS)
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    rows = decontamination.contaminated(frame, benchmark).collect()
    found = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows}
    assert found == {k: round(v, 9) for k, v in brute_contaminated(docs, items).items()}
    assert len(rows) == len(found)
    assert decontamination.contaminated(frame.limit(0), benchmark).count() == 0
    assert decontamination.contaminated(frame, benchmark.limit(0)).count() == 0


def check_nearest(rows, vectors, is_query, k, least):
    good = {i: np.array(v, float) for i, v in vectors}
    by: dict = {}
    for r in rows:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in [i for i in good if is_query(i)]:
        want = sorted(((-float(good[q] @ x), i) for i, x in good.items() if i != q))[:k]
        got = sorted(by.get(q, []))
        assert [g[0] for g in got] == list(range(1, len(want) + 1))
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        for _, i, s in got:
            assert abs(s - float(good[q] @ good[i])) < 1e-9
        hits += len({i for _, i in want} & {g[1] for g in got})
        total += len(want)
    assert total and hits / total >= least


def test_nearest_recall(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, (rng.normal(size=16) * rng.uniform(0.2, 3)).astype(np.float32).tolist()) for i in range(1500)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    rows = nn_descent.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    check_nearest(rows, vectors, lambda i: i % 20 == 0, 20, 0.95)


def test_nearest_edges(spark):
    same = [1.0, 0.5]
    vectors = [(i, same) for i in range(30)] + [(100, [0.1, 1.0]), (120, [1.0, 0.0])]
    odd = [(40, None), (41, [0.0, 0.0]), (60, [1.0, None]), (43, [float("nan"), 1.0]), (44, [float("inf"), 1.0]),
           (45, [1.0, 2.0, 3.0]), (None, same), (3, same), (80, [])]
    frame = spark.createDataFrame([(*v, 1) for v in vectors + odd], "vec_id long, embedding array<double>, query int")
    rows = nn_descent.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    check_nearest(rows, vectors, lambda i: i % 20 == 0, 20, 1.0)
    assert nn_descent.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nn_descent.nearest(frame.where("vec_id = 100"), F.lit(True)).count() == 0
    few = nn_descent.nearest(frame.where("vec_id in (100, 120, 0)"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in few] == [120, 100]


def test_pipeline(spark):
    import corpus_pipeline
    from tripmart.llm.common import stored

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, "s", 0), (9002, "", "en", None, 0), (9003, "123", "en", "s", 3),
                                   (None, "Only the name of it remains here", None, "s", 32)], docs.schema)
    docs = docs.unionByName(extra)
    first = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, sf), name)
        assert out.columns == docs.columns
        docs = out
    kept = {r["doc_id"]: r for r in docs.collect()}
    assert not {9001, 9002, 9003} & kept.keys() and None in kept
    texts = Counter(r["text"] for r in first)
    for text, n in texts.items():  # one of each group of exact copies at most
        assert sum(r["doc_id"] in kept for r in first if r["text"] == text) <= 1 or n == 1
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for r in first:
        if r["doc_id"] in kept:
            assert not any(t in (r["text"] or "") for _, t in items)
    assert not any(re.search(r"[\w.]+@[\w-]+\.\w+", r["text"]) for r in kept.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(kept)


def test_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_sql_matches(spark):
    from tests.oracle_compare import duck
    from tripmart.llm.queries import ORACLE_SQL, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duck(sf)
    for name, sql in ORACLE_SQL.items():
        frame = QUERIES[name](spark, sf)
        columns = sorted(frame.columns)
        got = sorted(map(str, (tuple(r[c] for c in columns) for r in frame.collect())))
        want = con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert got == sorted(map(str, want)), name


def nearest_rows(spark, vectors):
    vectors = [(i, np.asarray(v).astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    return nn_descent.nearest(frame, F.col("vec_id") % 20 == 0).collect(), vectors


def test_nearest_recall_with_long_vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24))
    x *= (rng.pareto(1.0, 1500) + 1)[:, None] / np.linalg.norm(x, axis=1)[:, None]
    x[7] *= 1e5 / np.linalg.norm(x[7])
    check_nearest(*nearest_rows(spark, x), lambda i: i % 20 == 0, 20, 0.95)


def test_nearest_finds_and_answers_the_odd_one_out(spark):
    rng = np.random.default_rng(6)
    x = np.r_[[[-1.0] + [0.0] * 15], np.c_[np.ones(1500), rng.normal(size=(1500, 15)) * 0.02]]
    rows, vectors = nearest_rows(spark, x)
    check_nearest(rows, vectors, lambda i: i % 20 == 0, 20, 0.95)
    assert sum(r["query_id"] == 0 for r in rows) == 20


def odd_documents(spark, extra="_row string, _t int, lang_pred string, score int, key int"):
    """Few documents with nulls, copies and columns whose names clash with helpers."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()
    rows = [tuple(r) for r in rows] + [(900, None, None, None, None), (901, "", "en", "s", 0), (902, " 12 ", None, "s", 4),
                                       (None, "some words of a null id", "en", None, 1)]
    rows += [rows[3], rows[3], (rows[5][0], "same id, other words entirely", "en", "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + extra
    return spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], schema), rows


def test_stages_keep_clashing_columns_and_odd_rows(spark):
    import corpus_pipeline

    docs, rows = odd_documents(spark)
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert {(r["_row"], r["_t"], r["lang_pred"], r["score"], r["key"]) for r in got} == {("x", 1, "y", 2, 3)}, name
        if name == "language_id":
            assert len(got) == len(rows) - 3 and all(r["lang"] for r in got)  # null, empty and letterless go
        elif name == "simhash_near_dedup":
            assert len({(r["doc_id"], r["text"]) for r in got}) == len(got) < len(rows)
        elif name == "pii":
            assert len(got) == len(rows) and sum(r["text"] is None for r in got) == 1
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


def test_language_sample_takes_distinct_texts(spark):
    from tripmart.llm import language_id

    seen = {}
    fit = language_id.fit
    try:
        language_id.fit = lambda texts, langs, *rest: seen.update(rows=list(zip(langs, texts, strict=True))) or fit(
            texts, langs, *rest)
        rows = [(i, "the very same text of english words", "en") for i in range(3000)]
        rows += [(5000 + i, f"other english words number {'abcdefghij'[i % 10]} {i}", "en") for i in range(60)]
        rows += [(7000 + i, f"quelques mots en français {i}", "fr") for i in range(9)] + [(9000, "ein " * 9000, "de"),
                                                                                       (9001, "zwei " * 9000, "de")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        model = language_id.train(docs, per_language=40)
        by = {lang: [t for x, t in seen["rows"] if x == lang] for lang, _ in seen["rows"]}
        assert len(by["en"]) == len(set(by["en"])) == 40 and len(by["de"]) == 1 and len(set(by["fr"])) >= 5
        found = language_id.identify(docs.where("lang = 'de'"), model).collect()
        assert found and all(r["lang_pred"] == "de" for r in found)
    finally:
        language_id.fit = fit


def test_language_kernel_is_that_of_all_shared_grams(spark):
    """Scores against ridge regression on plain sets of grams, every text a landmark."""
    from tripmart.llm import language_id

    texts = ["the cat sat on a mat", "le chat est la", "der hund ist da", "a dog on the mat", "la la chat", "da ist der hund"]
    langs = np.array(["en", "fr", "de", "en", "fr", "de"])
    asked = [*texts, "the dog", "le la", "hund da", "Ein HUND"]
    names, max_n, ridge = sorted(set(langs)), 3, 0.1

    def plain(text):
        t = text.lower()
        return {t[i:i + n] for n in range(1, max_n + 1) for i in range(len(t) - n + 1)}

    order = [0, 1, 2, 3, 4, 5]
    kernel = np.array([[len(plain(a) & plain(b)) / np.sqrt(len(plain(a)) * len(plain(b))) for b in texts] for a in asked])
    inner, weigh = kernel[order], np.diag([len(texts) / len(names) / (langs == x).sum() for x in langs])
    wanted = np.where(langs[:, None] == np.array(names), 1.0, -1.0)
    left = inner.T @ weigh @ inner + ridge * inner + 1e-8 * np.eye(len(texts))
    scores = kernel @ np.linalg.solve(left, inner.T @ weigh @ wanted)
    model = language_id.fit(texts, list(langs), len(texts), max_n, ridge)
    got, score = language_id.predict(model, [*asked, None, "123"], np.zeros(1 << language_id.BITS, np.int32))
    assert got == [names[i] for i in scores.argmax(axis=1)] + ["und", "und"]
    assert np.allclose(score, [*np.clip((scores.max(axis=1) + 1) / 2, 0, 1), 0, 0], atol=2e-4)


def peak_mb(fn):
    tracemalloc.start()
    fn()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_a_task_of_the_neighbour_graph_takes_bounded_memory():
    rng = np.random.default_rng(0)
    codes = nn_descent._packed(rng.normal(size=(nn_descent.BLOCK, 65)))
    meeting = pd.DataFrame({"center": np.arange(nn_descent.BLOCK) // 64, "node": np.arange(nn_descent.BLOCK), "code": codes,
                            "least": np.float32(-np.inf)})
    assert peak_mb(lambda: nn_descent._meet(meeting)) < 70
    opened = pd.DataFrame({"query": np.arange(2048), "least": np.float32(-np.inf), "asks": codes[:2048],
                           "nodes": np.arange(75).tobytes(), "codes": b"".join(codes[:75])})
    assert peak_mb(lambda: [None for _ in nn_descent._look(iter([opened]))]) < 40


def test_wide_rows_come_in_small_batches(spark):
    sizes = lambda it: (pd.DataFrame({"n": [len(x)]}) for x in it)
    most = lambda: spark.range(0, 3000, 1, 1).mapInPandas(sizes, "n long").agg(F.max("n")).first()[0]
    with batch_rows(spark, nn_descent.WIDE):
        assert most() <= nn_descent.WIDE
    assert most() == 3000


def test_tables_of_known_size_are_written_by_few_tasks(spark):
    """A file for each task: as many as the rows need, not as there are shuffle partitions."""
    rng = np.random.default_rng(4)
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(300, 8)))],
                                    "vec_id long, embedding array<double>")
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "x long, y long")
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    top = os.path.dirname(scratch_dir(spark, "llm")).removeprefix("file://").removeprefix("file:")
    old = set(glob.glob(f"{top}/*/*"))
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        found = nn_descent.nearest(vectors, F.col("vec_id") % 3 == 0, k=5).collect()
        roots = {r["root"] for r in components(chain, "x", "y").collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(found) == 500 and roots == {0}
    files = {}
    for path in set(glob.glob(f"{top}/*/*")) - old:
        files.setdefault(path.split("/")[-2], []).append(len(glob.glob(f"{path}/part-*")))
    few = spark.sparkContext.defaultParallelism
    assert {"graph", "pool", "adjacency", "nodes", "asking", "queries", "edges"} <= set(files)
    assert all(n <= few for name in ("graph", "pool", "adjacency", "nodes", "asking", "queries") for n in files[name])
    # The first table of links has an unknown size.
    assert sum(n > few for n in files["edges"]) <= 1
