"""Approximate nearest neighbours by inner product: NN-descent and greedy search.

The neighbour graph starts from random-hyperplane trees and groups dealt at
random, and is refined by rounds of Spark joins: every node's neighbours, out
and in, meet at that node and are compared with each other (neighbours of
neighbours); each keeps its best. A query walks the graph: in every hop its
best nodes that are not expanded yet are joined with their adjacency rows,
and the best ``pool`` nodes are kept, until all of them are expanded. A walk
also starts at nodes shared by all queries, and links dealt at random join
parts of the graph that no neighbour joins.

Largest inner products become least distances by one more component that
gives all vectors the largest norm (zero in queries). It is kept as what it
lacks of that norm, which neither distances nor the order of inner products
depend on, and so are vectors centred on the mean of the shorter half. Graph
and walk use vectors rounded to sixteen bits, each in a scale of its own;
results are ranked by the exact inner product in double precision. Equal
vectors are one node. A node keeps the ``k`` + 1 smallest of its ids, which
is all that ties to smaller ids can ever return.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import batch_rows, map_batches, shuffle_width, stored

#: Neighbours kept, out and in; trees and nodes of a leaf at the start;
#: rounds; candidates a node may send to another from one meeting.
DEGREE, TREES, LEAF, ROUNDS, OFFERS = 32, 6, 64, 4, 8
#: Nodes a query keeps and expands in a hop, and those ranked exactly.
POOL, EXPAND, EXACT = 300, 60, 64
#: Trees whose leaves are dealt at random; nodes, of the longest and of any,
#: where every walk starts; rounds and group size of the random links.
RANDOM, ENTRIES, LINKS, LINKED = 1, 32, 2, 6
#: Rows handled at once; numbers of a matrix of compared groups; rows with the
#: neighbours' codes (some 10 KB each) in an Arrow batch, and decoded at once.
BLOCK, NUMBERS, WIDE, DECODED = 1 << 15, 1 << 20, 1024, 256
EDGE = "src long, dst long, sim float"


def by_group(batches: Iterator[pd.DataFrame], group: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
             block: int = BLOCK) -> Iterator[pd.DataFrame]:
    """Apply ``fn`` to blocks of whole groups of rows sorted by ``group``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= block:
            rows = pd.concat(held, ignore_index=True)
            last = np.logical_and.reduce([(rows[g] == rows[g].iloc[-1]).to_numpy() for g in group])
            if not last.all():
                yield fn(rows[~last].reset_index(drop=True))
            held, size = [rows[last]], 0
    if held and sum(map(len, held)):
        yield fn(pd.concat(held, ignore_index=True))


def grouped(df: DataFrame, keys: list[str], order: list, fn: Callable, schema: str) -> DataFrame:
    """``fn`` over blocks of whole groups, without a call for each group."""
    dealt = df.repartition(shuffle_width(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)
    return map_batches(dealt, lambda it: by_group(it, keys, fn), schema)


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row's scale (float32) and its components in sixteen bits."""
    scale = (np.abs(x).max(axis=1) / 32767).astype(np.float32)
    part = np.rint(x / np.where(scale > 0, scale, 1)[:, None].astype(np.float64)).clip(-32767, 32767).astype("<i2")
    return [a.tobytes() + b.tobytes() for a, b in zip(scale.astype("<f4"), part, strict=True)]


def _unpacked(data: bytes, rows: int) -> np.ndarray:
    size = (len(data) // max(1, rows) - 4) // 2
    given = np.frombuffer(data, [("scale", "<f4"), ("part", "<i2", (size,))])
    return given["part"] * given["scale"][:, None]


def _codes(column: pd.Series) -> np.ndarray:
    return _unpacked(b"".join(column), len(column))


def _starts(*keys: np.ndarray) -> np.ndarray:
    """First row of each run of equal keys, and the number of rows."""
    new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.r_[np.flatnonzero(np.r_[True, new]), len(keys[0])]


def _matrix(first: np.ndarray, width: int) -> np.ndarray:
    """Row numbers of each group, padded with -1 to ``width``."""
    size = np.minimum(np.diff(first), width)
    at = first[:-1, None] + np.arange(width)
    return np.where(np.arange(width) < size[:, None], at, -1)


def _extended(batch: pd.DataFrame, norm: float) -> np.ndarray:
    """Vectors in units of the norm, and what their last component lacks."""
    x = np.stack(batch["vec"]).astype(np.float64) / norm
    square = np.minimum((x * x).sum(axis=1), 1)
    return np.c_[x, square / (1 + np.sqrt(1 - square))]


def _sums(batches: Iterator[pd.DataFrame], norm: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield pd.DataFrame({"n": [len(batch)], "total": [_extended(batch, norm).sum(axis=0).tolist()]})


def _encode(batches: Iterator[pd.DataFrame], norm: float, centre: np.ndarray) -> Iterator[pd.DataFrame]:
    """Codes of nodes (extended and centred) and of queries."""
    for batch in batches:
        if not len(batch):
            continue
        x = np.stack(batch["vec"]).astype(np.float64)
        asked = x / np.abs(x).max(axis=1)[:, None]
        asked /= np.sqrt((asked * asked).sum(axis=1))[:, None]
        yield batch.assign(code=_packed(_extended(batch, norm) - centre), asks=_packed(np.c_[asked, np.zeros(len(x))]))


def _leaves(batches: Iterator[pd.DataFrame], depth: int, trees: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        x = _codes(batch["code"])
        for tree in range(trees):
            plane = np.random.default_rng(tree).normal(size=(x.shape[1], depth))
            leaf = (x @ plane > 0) @ (1 << np.arange(depth, dtype=np.int64))
            yield batch.assign(tree=np.int32(tree), leaf=leaf.astype(np.int64))


def _offers(rows: pd.DataFrame, first: np.ndarray, width: int, offers: int, ids: np.ndarray,
            least: np.ndarray | None) -> pd.DataFrame:
    """The nearest ``offers`` others of each member of each group of rows."""
    found, code = [], _codes(rows["code"])
    step = max(1, NUMBERS // (width * max(width, code.shape[1])))
    for a in range(0, len(first) - 1, step):
        at = _matrix(first[a:a + step + 1], width)
        x = code[np.maximum(at, 0)]
        square = (x * x).sum(axis=2)
        sim = 2 * (x @ x.transpose(0, 2, 1)) - square[:, :, None] - square[:, None, :]
        sim[np.broadcast_to((at < 0)[:, None, :], sim.shape)] = -np.inf
        sim[:, np.arange(width), np.arange(width)] = -np.inf
        best = min(offers, width - 1)
        to = np.argpartition(-sim, best - 1, axis=2)[:, :, :best]
        sim = np.take_along_axis(sim, to, 2)
        to = np.take_along_axis(np.broadcast_to(at[:, None, :], (len(at), width, width)), to, 2)
        own = np.broadcast_to(at[:, :, None], to.shape)
        ok = (own >= 0) & np.isfinite(sim)
        if least is not None:
            ok &= sim > least[np.maximum(own, 0)]
        found.append((own[ok], to[ok], sim[ok]))
    own, to, sim = (np.concatenate(x) for x in zip(*found, strict=True))
    out = pd.DataFrame({"src": ids[own], "dst": ids[to], "sim": sim})
    return out[out["src"] != out["dst"]].drop_duplicates(["src", "dst"])


def _first_edges(rows: pd.DataFrame) -> pd.DataFrame:
    """Best neighbours inside leaves; a large leaf is taken in parts."""
    first = _starts(rows["tree"].to_numpy(), rows["leaf"].to_numpy(), rows["salt"].to_numpy())
    part = [np.arange(a, b, 4 * LEAF) for a, b in zip(first[:-1], first[1:], strict=True)]
    first = np.r_[np.concatenate(part), len(rows)]
    size, out = np.diff(first), []
    for low, high, best in ((2, DEGREE + 1, DEGREE), (DEGREE + 2, 4 * LEAF, DEGREE // 2)):
        for g in np.flatnonzero((size >= low) & (size <= high)):
            some = rows.iloc[first[g]:first[g + 1]]
            out.append(_offers(some, np.array([0, len(some)]), len(some), best, some["node"].to_numpy(), None))
    return pd.concat(out) if out else pd.DataFrame({"src": [], "dst": [], "sim": []})


def _best(rows: pd.DataFrame, key: str, other: str, keep: int) -> pd.DataFrame:
    """Each key's ``keep`` most similar different others."""
    rows = rows.sort_values([key, "sim", other], ascending=[True, False, True], ignore_index=True)
    rows = rows.drop_duplicates([key, other], ignore_index=True)
    first = _starts(rows[key].to_numpy())
    nth = np.arange(len(rows)) - np.repeat(first[:-1], np.diff(first))
    return rows[nth < keep]


def _keep(rows: pd.DataFrame) -> pd.DataFrame:
    return _best(rows, "src", "dst", DEGREE)


def _keep_in(rows: pd.DataFrame) -> pd.DataFrame:
    return _best(rows, "dst", "src", DEGREE)


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Compare the neighbours of each node with each other."""
    rows = rows.drop_duplicates(["center", "node"], ignore_index=True)
    return _offers(rows, _starts(rows["center"].to_numpy()), 2 * DEGREE, OFFERS, rows["node"].to_numpy(),
                   rows["least"].to_numpy())


def _adjacent(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.drop_duplicates(["center", "node"], ignore_index=True)
    first, node, code = _starts(rows["center"].to_numpy()), rows["node"].to_numpy(), rows["code"].tolist()
    cuts = list(zip(first[:-1], first[1:], strict=True))
    return pd.DataFrame({"center": rows["center"].to_numpy()[first[:-1]], "nodes": [node[a:b].tobytes() for a, b in cuts],
                         "codes": [b"".join(code[a:b]) for a, b in cuts]})


def _neighbours(edges: DataFrame) -> DataFrame:
    """center, node: neighbours out, and the nearest that point here."""
    into = grouped(edges, ["dst"], [], _keep_in, EDGE)
    return edges.select(F.col("src").alias("center"), F.col("dst").alias("node")).unionByName(
        into.select(F.col("dst").alias("center"), F.col("src").alias("node")))


def build_graph(nodes: DataFrame, count: int) -> DataFrame:
    """src, dst, sim: DEGREE neighbours of each node (node, code)."""
    spark = nodes.sparkSession
    depth = max(0, int(np.ceil(np.log2(max(1, count) / LEAF))))
    leaves = map_batches(nodes.select("node", "code"), lambda it: _leaves(it, depth, TREES),
                         "node long, code binary, tree int, leaf long")
    for tree in range(TREES, TREES + RANDOM):
        leaves = leaves.unionByName(nodes.select("node", "code", F.lit(tree).alias("tree"), F.pmod(
            F.xxhash64("node", F.lit(tree)), F.lit(count // LEAF + 1)).alias("leaf")))
    sizes = leaves.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / 4096).cast("int").alias("salts"))
    leaves = leaves.join(sizes, ["tree", "leaf"]).withColumn("deal", F.xxhash64("tree", "node"))
    leaves = leaves.withColumn("salt", F.pmod(F.shiftrightunsigned("deal", 32), F.col("salts")))
    first = grouped(leaves.drop("salts"), ["tree", "leaf", "salt"], ["deal"], _first_edges, EDGE)
    edges = stored(grouped(first, ["src"], [], _keep, EDGE), "graph", count * (TREES + RANDOM) * DEGREE)
    for _ in range(ROUNDS):
        least = edges.groupBy(F.col("src").alias("node")).agg(
            F.when(F.count("*") >= DEGREE, F.min("sim")).otherwise(float("-inf")).cast("float").alias("least"))
        known = nodes.select("node", "code").join(least, "node", "left").fillna(float("-inf"), "least")
        meeting = _neighbours(edges).join(known, "node")
        offers = grouped(meeting, ["center"], [], _meet, EDGE)
        edges = stored(grouped(edges.unionByName(offers), ["src"], [], _keep, EDGE), "graph",
                       count * DEGREE * (1 + 2 * OFFERS))
        del least, known, meeting, offers
        spark._jvm.System.gc()  # lets Spark drop the shuffle files of the round
    return edges


def _look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Similarity of the expanded nodes' neighbours to their queries."""
    for batch in batches:
        for a in range(0, len(batch), DECODED):
            rows = batch.iloc[a:a + DECODED]
            size = rows["nodes"].str.len().to_numpy() // 8
            node = np.frombuffer(b"".join(rows["nodes"]), np.int64)
            row = np.repeat(np.arange(len(rows)), size)
            code = _unpacked(b"".join(rows["codes"]), len(node))
            sim = np.einsum("ij,ij->i", code, _codes(rows["asks"])[row])
            ok = sim > rows["least"].to_numpy()[row]
            yield pd.DataFrame({"query": rows["query"].to_numpy()[row[ok]], "node": node[ok], "sim": sim[ok],
                                "done": np.zeros(ok.sum(), bool)})


def _pool(rows: pd.DataFrame, pool: int, expand: int) -> pd.DataFrame:
    """Each query's best nodes; ``now`` marks those to expand next, and
    ``least`` is the similarity a new node must exceed."""
    rows = rows.sort_values(["query", "sim", "node", "done"], ascending=[True, False, True, False], ignore_index=True)
    rows = rows.drop_duplicates(["query", "node"], ignore_index=True)
    first = _starts(rows["query"].to_numpy())
    nth = np.arange(len(rows)) - np.repeat(first[:-1], np.diff(first))
    rows = rows[nth < pool].reset_index(drop=True)
    first = _starts(rows["query"].to_numpy())
    size = np.diff(first)
    fresh = ~rows["done"].to_numpy()
    turn = np.cumsum(fresh) - np.repeat((np.cumsum(fresh) - fresh)[first[:-1]], size)
    now = fresh & (turn <= expand)
    sim = rows["sim"].to_numpy()
    least = np.where(size >= pool, sim[first[1:] - 1], -np.inf).astype(np.float32)
    return rows.assign(done=rows["done"].to_numpy() | now, now=now, least=np.repeat(least, size))


def _enter(batches: Iterator[pd.DataFrame], node: np.ndarray, code: np.ndarray) -> Iterator[pd.DataFrame]:
    """Similarity of the shared first nodes to the queries."""
    for batch in batches:
        for a in range(0, len(batch), 2048):
            rows = batch.iloc[a:a + 2048]
            sim = _codes(rows["asks"]) @ code.T
            yield pd.DataFrame({"query": np.repeat(rows["query"].to_numpy(), len(node)), "node": np.tile(node, len(rows)),
                                "sim": sim.ravel(), "done": np.zeros(sim.size, bool)})


def _links(nodes: DataFrame, count: int) -> DataFrame:
    """center, node: both ways between members of small random groups."""
    some = nodes.select("node", F.explode(F.array(*[F.lit(-1 - i) for i in range(LINKS)])).alias("deal"))
    some = some.withColumn("at", F.pmod(F.xxhash64("node", "deal"), F.lit(count // LINKED + 1)))
    return some.withColumnRenamed("node", "center").join(some, ["deal", "at"]).where("center != node").select(
        "center", "node")


def search(queries: DataFrame, nodes: DataFrame, edges: DataFrame, count: int, k: int, pool: int = POOL,
           expand: int = EXPAND) -> DataFrame:
    """query, node, sim: the pool of each query (query: a node; asks: its code).

    The shared first nodes are more than ``k``, or all there are, so that no
    pool is too small.
    """
    state = "query long, node long, sim float, done boolean, now boolean, least float"
    spark, width, pool = nodes.sparkSession, shuffle_width(nodes.sparkSession), max(pool, k + 1)
    around = grouped(_neighbours(edges).unionByName(_links(nodes, count)).join(nodes.select("node", "code"), "node"),
                     ["center"], [], _adjacent, "center long, nodes binary, codes binary")
    # Dealt by node once and kept; every hop joins it where it is.
    around = stored(around, "adjacency", count * 16 * (DEGREE + LINKED)).repartition(width, "center").persist()
    first = {r["node"]: bytes(r["code"]) for order, n in ((F.desc("norm"), ENTRIES), (F.xxhash64("node"), max(ENTRIES, k + 1)))
             for r in nodes.orderBy(order, "node").select("node", "code").limit(n).collect()}
    node, code = np.array(list(first), np.int64), _unpacked(b"".join(first.values()), len(first))
    entered = map_batches(queries.select("query", "asks"), lambda it: _enter(it, node, code),
                          "query long, node long, sim float, done boolean")
    own = queries.select("query", F.col("query").alias("node"), F.lit(float("inf")).cast("float").alias("sim"),
                         F.lit(False).alias("done"))
    asked = queries.count()
    table = stored(grouped(own.unionByName(entered), ["query"], [], lambda rows: _pool(rows, pool, expand), state), "pool",
                   asked * (len(first) + 1))
    while table.where("now").limit(1).count():
        ahead = table.where("now").join(queries, "query").select("query", "node", "least", "asks")
        opened = around.join(ahead.hint("shuffle_hash"), F.col("center") == F.col("node")).select(
            "query", "least", "asks", "nodes", "codes")
        seen = map_batches(opened, _look, "query long, node long, sim float, done boolean")
        both = table.select("query", "node", "sim", "done").unionByName(seen)
        with batch_rows(spark, WIDE):
            table = stored(grouped(both, ["query"], [], lambda rows: _pool(rows, pool, expand), state), "pool",
                           asked * (pool + expand * 2 * (DEGREE + LINKED)))
        spark._jvm.System.gc()
    around.unpersist()
    return table.select("query", "node", "sim")


def _norm(a: Column) -> Column:
    most = F.array_max(F.transform(a, lambda x: F.abs(x.cast("double"))))
    return most * F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + (x / most) * (x / most)))


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda s, x: s + x)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query.

    ``is_query`` selects the rows that ask; every other row is a candidate.
    Rows with a null id, and vectors that are null, zero, hold a null or
    non-finite component or have another length than most, take no part.
    Repeated rows count once; of different vectors with one id the smallest
    counts. Other columns are ignored. An empty table, or a single vector,
    gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.withColumn("asks_it", is_query).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec"), "asks_it")
    finite = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite
                      & F.exists("vec", lambda x: x != 0))
    rows = stored(rows.groupBy("vec_id").agg(F.min("vec").alias("vec"), F.max("asks_it").alias("asks_it")).withColumn(
        "norm", _norm(F.col("vec"))), "vectors")
    shape = rows.groupBy(F.size("vec").alias("n")).agg(
        F.count("*").alias("c"), F.max("norm").alias("norm"), F.percentile_approx("norm", 0.5).alias("half")).orderBy(
        F.desc("c"), "n").first()
    result = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("vec") == shape["n"])
    nth = Window.partitionBy("vec").orderBy("vec_id")
    ids = rows.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k + 1)
    nodes = ids.groupBy("vec").agg(F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("ids"),
                                   F.min("norm").alias("norm"))
    norm = float(shape["norm"])
    vec_type = rows.schema["vec"].dataType.simpleString()
    sums = map_batches(rows.where(F.col("norm") <= shape["half"]).select("vec"), lambda it: _sums(it, norm),
                       "n long, total array<double>")
    sums = sums.select("n", F.posexplode("total").alias("at", "x")).groupBy("at").agg(
        (F.sum("x") / F.sum("n")).alias("mean")).orderBy("at").collect()
    centre = np.array([r["mean"] for r in sums])
    nodes = stored(map_batches(nodes, lambda it: _encode(it, norm, centre), f"vec {vec_type}, node long, "
                               "ids array<long>, norm double, code binary, asks binary"), "nodes", shape["c"] * 16)
    asking = rows.where("asks_it").select("vec_id", "vec").join(nodes.select("vec", "node"), "vec").select(
        F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    asking = stored(asking, "asking", shape["c"])
    queries = stored(asking.select("query").distinct().join(
        nodes.select(F.col("node").alias("query"), "asks", F.col("vec").alias("query_vec")), "query"), "queries", shape["c"])
    count = nodes.count()
    edges = build_graph(nodes, count)
    found = search(queries.select("query", "asks"), nodes, edges, count, k)
    found = found.unionByName(queries.select("query", F.col("query").alias("node"), F.lit(0.0).cast("float").alias("sim")))
    # Candidates by rounded vectors, then the exact product of the originals.
    best = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    found = found.groupBy("query", "node").agg(F.max("sim").alias("sim")).withColumn(
        "nth", F.row_number().over(best)).where((F.col("nth") <= max(EXACT, k) + 1) | (F.col("query") == F.col("node")))
    scored = (found.select("query", "node").join(nodes.select("node", "vec", "ids"), "node")
              .join(queries.select("query", "query_vec"), "query")
              .select("query", _product(F.col("query_vec"), F.col("vec")).alias("score"),
                      F.explode("ids").alias("vec_id")))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = (scored.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).groupBy("query")
           .agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("top")))
    # Copies that ask share one list; each leaves itself out.
    mine = F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("query_id")), 1, k)
    return asking.join(top, "query").select("query_id", F.posexplode(mine).alias("at", "t")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"),
        F.col("t.score").alias("score"))


def op9_nn_descent(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, k=20)
