"""Url reputation, lexical search and centroid clustering against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck
from tripmart.llm import centroid_clustering, lexical_search, queries, url_reputation


@pytest.mark.parametrize("name", ["op11_url_reputation", "op12_lexical_search", "op13_centroid_clustering"])
def test_equals_sql(spark, name):
    found = compare(spark, SF_SMALL, name, queries.QUERIES[name], queries.ORACLE_SQL[name], duck(SF_SMALL))
    assert found["ok"], found


# --- url reputation -------------------------------------------------------

URLS = [None, "", "no-host", "http://", "http://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "ftp://x.org",
        "http://x.org/", "http://notorg/fr/", "http://com/fr/", "http://a.com/de/1", "http://a.com/en/1",
        "http://b.a.com/de/2", "http://u:p@h.org:80/z", "http://h.org:80/z", "http://ÄB.org/x", "a://b://c.org/",
        "http://x.com\n/fr/", "http://1.2.3.4/de/", "//x.org/", "http://x.org?q=/es/", "http://shop.co.uk/de/"]


def page_rows(spark, urls, ids=None):
    rows = [(i, u, "h", "p", "t", 1) for i, u in zip(ids or range(len(urls)), urls, strict=True)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, path string, tail_1 string, best int")


def split(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return (found[1].translate(lower), found[2]) if found else ("", "")


def rule_of(host, path, rules):
    fits = [(len(h + p), v, h + p) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls_and_rules(spark):
    got = {r["page_id"]: r for r in url_reputation.judge(page_rows(spark, URLS), url_reputation.RULES).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = split(url)
        verdict, rule = rule_of(host, path, url_reputation.RULES)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] == (verdict or got[i]["verdict"])


def brute_reputation(hosts):
    """hosts: host -> (n, bad). The formulas of the module, in plain Python."""
    def key(host):
        parts = host.split(".")
        return ".".join(parts[-2:]), parts[-1]

    def level(of, prior):
        groups = {}
        for h, (n, bad) in hosts.items():
            k, above = of(h)
            g = groups.setdefault(k, [0, 0, prior[above]])
            g[0], g[1] = g[0] + n, g[1] + bad
        used = [g for g in groups.values() if g[0]]
        x = sum((b - n * p) ** 2 / (n * p * (1 - p)) for n, b, p in used)
        free = sum(n - 1 for n, _, _ in used)
        rho = 0.5 if not free else min(0.999, max(0.001, (x - len(used)) / free))
        m = round((1 - rho) / rho, 6)
        return m, {k: (m * p + b) / (m + n) for k, (n, b, p) in groups.items()}, groups

    n, bad = (sum(v[i] for v in hosts.values()) for i in (0, 1))
    _, suffix, _ = level(lambda h: (key(h)[1], ""), {"": (bad + 1) / (n + 2)})
    _, domain, _ = level(lambda h: key(h), suffix)
    m, mean, groups = level(lambda h: (h, key(h)[0]), domain)
    out = {}
    for h, (n, bad, p) in groups.items():
        a, b = m * p + bad, m * (1 - p) + n - bad
        out[h] = (mean[h], mean[h] - 1.645 * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))))
    return out


def test_reputation_equals_plain_formulas_and_shrinks(spark):
    counts = {"good.a.com": (300, 3), "new.a.com": (0, 0), "few.a.com": (2, 2), "bad.b.net": (200, 190),
              "young.b.net": (1, 0), "x.c.org": (40, 20), "alone.d.org": (0, 0)}
    rows = [(h, i < bad) for h, (n, bad) in counts.items() for i in range(n)]
    rows += [(h, None) for h, (n, _) in counts.items()]
    got = {r["host"]: r for r in url_reputation.reputations(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    want = brute_reputation(counts)
    assert set(got) == set(counts)
    for h, (mean, bound) in want.items():
        assert got[h]["mean"] == pytest.approx(mean, abs=1e-6) and got[h]["bound"] == pytest.approx(bound, abs=1e-6)
    assert got["few.a.com"]["bound"] < url_reputation.LIMIT < got["bad.b.net"]["bound"]  # two bad pages block nothing
    assert got["young.b.net"]["mean"] > got["new.a.com"]["mean"]


def test_outcomes_of_the_caller_decide(spark):
    pages = page_rows(spark, ["http://s.bad.com/1", "http://s.bad.com/2", "http://t.fine.com/1"])
    rows = [("s.bad.com", True)] * 50 + [("t.fine.com", False)] * 50
    found = url_reputation.judge(pages, [], spark.createDataFrame(rows, "host string, bad boolean"))
    assert [r["verdict"] for r in found.orderBy("page_id").collect()] == ["block", "block", "allow"]


def test_url_edges(spark):
    empty = url_reputation.judge(page_rows(spark, []), url_reputation.RULES)
    assert empty.count() == 0
    again = url_reputation.judge(page_rows(spark, [*URLS, *URLS], [None, *range(1, 2 * len(URLS))]), url_reputation.RULES)
    assert again.count() == 2 * len(URLS)
    assert url_reputation.judge(page_rows(spark, ["http://a." + "b" * 100_000 + ".org/" + "c" * 100_000]),
                                url_reputation.RULES).first()["verdict"] == "allow"


def test_urls_need_no_python(spark):
    plan = url_reputation.op11_url_reputation(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- lexical search -------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                      (text or "").translate({ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))


def brute_search(docs, items, k=10):
    bags = [(i, Counter(words(t))) for i, t in docs]
    n, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scored = []
        for i, b in bags:
            size = sum(b.values())
            m = 25 + (75 * size * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                    for t in words(text) if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def search(spark, docs, items, **given):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n int, term int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, item int")
    return sorted([tuple(r) for r in lexical_search.rank(d, q, **given).collect()], key=str)


ODD = [None, "", " ,.;", "A a Ä ä", "x\x7fy_z`w", "İstanbul K 北京 北京", "tab\tnew\nline\x00nul", "a" * 3000, "1 22 1 x9"]


def test_search_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(60)], k=rng.randint(0, 40)))) for i in range(300)]
    docs += [(1000 + i, t) for i, t in enumerate(ODD)] + [(5, docs[5][1]), (None, docs[7][1]), (2000, docs[7][1])]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for i in range(25)]
    items += [(50 + i, t) for i, t in enumerate(ODD)] + [items[3], (3, "w1 w2 w2"), (None, "w4")]
    want = brute_search(docs, items)
    assert search(spark, docs, items) == want
    assert search(spark, docs, items, shard_postings=40, block_terms=15) == want
    assert search(spark, docs, items, k=3, shard_postings=1) == brute_search(docs, items, 3)


def test_search_edges(spark):
    assert search(spark, [], [(1, "a")]) == [] and search(spark, [(1, "a")], []) == []
    assert search(spark, [(1, None), (2, " ")], [(1, "a")]) == []
    assert search(spark, [(1, "a"), (2, "b")], [(1, None), (2, "..."), (3, "c")]) == []
    ties = [(i, "same words here") for i in range(40, 0, -1)] + [(99, "other")]
    assert [r[2] for r in sorted(search(spark, ties, [(1, "same")], shard_postings=7), key=lambda r: r[1])] == [*range(1, 11)]


def test_long_documents_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical_search, "_PIECE", 64)
    text = " ".join(f"t{i % 97}" for i in range(5000)) + " " + "Z" * 500
    known = {b"t3": 0, b"t96": 1, b"z" * 500: 2, b"zz": 3}
    count = Counter(words(text))
    assert lexical_search._counted(text.encode(), known) == (5001, [(0, count["t3"]), (1, count["t96"]), (2, 1)])


def test_best_positions_stop_early():
    """A list whose best documents stand out is not read to its end."""
    n = 50_000
    rng = np.random.default_rng(3)
    term = [np.array([0, 1], np.int32)] * n
    tf = [np.array(x, np.int64) for x in rng.integers(1, 4, (n, 2))]
    for i in range(20):
        tf[i * 100] = np.array([500 + i, 500 + i], np.int64)
    shard = lexical_search._Shard(np.array([*range(n)], object), np.full(n, 4), term, tf, n, 4 * n)
    read, postings = [], shard.postings
    shard.postings = lambda docs: (read.append(len(docs)), postings(docs))[1]
    top = lexical_search._best(shard, np.array([0, 1]), np.array([10, 7]), np.array([10, 7]), [], 10)
    every = [(-int(10 * a + 7 * b), False, i) for i, (a, b) in enumerate(shard.impact.reshape(-1, 2))]
    assert top == sorted(every)[:10]
    assert sum(read) < n // 100


# --- centroid clustering --------------------------------------------------

def brute_nearest(vectors, centroids):
    return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids)) for v in vectors]


@pytest.mark.parametrize("kind, size", [(np.int64, 3), (np.int64, 5000), (object, 1 << 40)])
@pytest.mark.parametrize("k", [1, 2, 9, 40])
def test_nearest_by_threshold(kind, size, k):
    rng = np.random.default_rng(k)
    vectors = rng.integers(-size, size, (120, 5)).astype(kind)
    centroids = rng.integers(-size, size, (k, 5)).astype(kind)
    if k > 2:
        centroids[k - 1] = centroids[0]  # ties go to the smaller number
    got = centroid_clustering.nearest(vectors, centroids)
    assert [*zip(got[1].tolist(), got[0].tolist(), strict=True)] == brute_nearest(vectors.tolist(), centroids.tolist())


def brute_clusters(rows, dimensions, k, rounds, seed=3):
    long = (1 << 63) - 1
    kept = [(i, [max(-long - 1, min(long, math.floor(1024 * float(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    draw = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in draw[:k]]
    for _ in range(rounds):
        found = [c for _, c in brute_nearest([v for _, v in kept], centroids)]
        for c in range(len(centroids)):
            mine = [v for (_, v), f in zip(kept, found, strict=True) if f == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = brute_nearest([v for _, v in kept], centroids)
    inertia = Counter()
    for d, c in found:
        inertia[c] += min(d, long)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, c, min(d, long), min(inertia[c], long), min(sum(inertia.values()), long), digest[c])
                   for (i, _), (d, c) in zip(kept, found, strict=True)], key=str)


def clusters(spark, rows, dimensions, **given):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, cluster int, distance string")
    return sorted([tuple(r) for r in centroid_clustering.cluster(df, dimensions=dimensions, **given).collect()], key=str)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(150)]
    rows += [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0] * 5 + [None]), (204, [math.nan] * 6),
             (205, [math.inf] * 6), (None, [0.5] * 6), (3, rows[3][1]), (206, [0.0] * 6), (207, [-0.0] * 6)]
    assert clusters(spark, rows, 6, k=5, rounds=4) == brute_clusters(rows, 6, 5, 4)


def test_cluster_edges(spark):
    assert clusters(spark, [], 3) == [] and clusters(spark, [(1, None), (2, [1.0])], 3) == []
    same = [(i, [1.5, -2.5]) for i in range(20)]
    assert clusters(spark, same, 2) == brute_clusters(same, 2, 8, 10)
    few = [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    assert clusters(spark, few, 2) == brute_clusters(few, 2, 8, 10)
    large = [(i, [s * 10.0**e, 1.0]) for i, (s, e) in enumerate((s, e) for s in (-1, 1) for e in (3, 9, 14, 30, 300))]
    assert clusters(spark, large, 2, k=3, rounds=3) == brute_clusters(large, 2, 3, 3)


def test_hot_vector(spark):
    """A third of all rows hold one vector: partial sums are a row a batch, whatever the cluster's size."""
    df = spark.range(0, 3000, numPartitions=3).select(
        F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(
            F.array(F.rand(1), F.rand(2))).alias("embedding"))
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert clusters(spark, rows, 2, k=4, rounds=3) == brute_clusters(rows, 2, 4, 3)
