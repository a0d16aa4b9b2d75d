"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph.  The graph is cut into partitions of equal
size by repeated bisection, and a softmax classifier learns to predict, for any vector, in which
partitions its neighbours lie.  Every vector of the table goes to its most probable partition; a
query is sent to its several most probable ones, and all vectors there are ranked exactly.  How many
those are is measured: as many as cover ``RECALL`` of the true neighbours of sample vectors that the
graph and the classifier have not seen.

Equal vectors are one class, found once and given back with their smallest ids.  A partition is
ranked block by block (vectors by queries), so no task holds a whole one.

Nearness is the cosine in double precision.  Defined cases: vectors that are null, zero, or hold null
or non-finite components take no part, nor do rows without id and vectors of another length than
most; of rows with equal ids and vectors one takes part; queries with few candidates get them all;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palate.session import settle

#: Vectors of the sample, at most; a part of them is kept apart to measure the routing.
SAMPLE = 8192
APART = 8
#: Vectors per partition, about, until ``MOST`` partitions; graph neighbours; share of neighbours to reach.
PER_PARTITION = 512
MOST = 256
FEW = 8
GRAPH = 10
RECALL = 0.98
#: Vectors and queries of one group.
BLOCK = 8192
QUERIES = 4096
SEED = 11


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(queries: np.ndarray, points: np.ndarray, k: int, skip_self: bool = False) -> np.ndarray:
    """Places of the ``k`` nearest points of each query, block by block."""
    out = []
    for at in range(0, len(queries), 512):
        s = queries[at : at + 512] @ points.T
        if skip_self:
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out.append(np.argpartition(-s, min(k, s.shape[1] - 1), axis=1)[:, :k])
    return np.concatenate(out)


def bisect(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Partitions of equal size of a neighbour graph (row: a node's neighbours); ``parts`` is a power of two."""
    n = len(graph)
    out = np.zeros(n, np.int64)
    rounds = int(np.log2(parts))
    for _ in range(rounds):
        same = out[graph] == out[:, None]
        degree = np.maximum(same.sum(axis=1), 1)
        back = [np.repeat(np.arange(n), graph.shape[1]), graph.ravel(), same.ravel()]
        x = rng.standard_normal(n)
        for _ in range(40):  # a walk along links within parts leaves the slowest-mixing direction
            drawn = np.bincount(back[1][back[2]], x[back[0][back[2]]], minlength=n)
            x = x + (np.where(same, x[graph], 0).sum(axis=1) + drawn) / degree
            mean = np.bincount(out, x) / np.maximum(np.bincount(out), 1)
            x = x - mean[out]
            x /= np.linalg.norm(x) + 1e-12
        order = np.lexsort((np.arange(n), x, out))
        first = np.r_[0, np.cumsum(np.bincount(out))]
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - first[out[order]]
        out = out * 2 + (place >= np.bincount(out)[out] // 2)
    return out


def learn(x: np.ndarray, goal: np.ndarray, steps: int = 300, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights of a softmax classifier with soft goals (Adam on all rows)."""
    w = np.zeros((x.shape[1] + 1, goal.shape[1]))
    z = np.hstack([x * np.sqrt(x.shape[1]), np.ones((len(x), 1))])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        s = z @ w
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = z.T @ (p - goal) / len(z) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1] * np.sqrt(x.shape[1]), w[-1]


def fit_sample(x: np.ndarray, parts: int, k: int) -> dict[str, np.ndarray]:
    """Classifier weights and the number of partitions to search."""
    rng = np.random.default_rng(SEED)
    x = unit(x.astype(float))
    held = np.arange(len(x)) % APART == 0
    train, test = x[~held], x[held]
    if parts < 2 or len(train) < 4 * parts or len(train) <= GRAPH:
        return {"w": np.zeros((x.shape[1], 1)), "b": np.zeros(1), "probes": np.array(1)}
    graph = nearest(train, train, GRAPH, skip_self=True)
    part = bisect(graph, parts, rng)
    goal = np.zeros((len(train), parts))
    for j in range(graph.shape[1]):
        goal[np.arange(len(train)), part[graph[:, j]]] += 1
    goal[np.arange(len(train)), part] += graph.shape[1] / 2
    goal /= goal.sum(axis=1, keepdims=True)
    w, b = learn(train, goal)
    home = (train @ w + b).argmax(axis=1)
    order = np.argsort(-(test @ w + b), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(len(order), 0), axis=1)
    found = np.take_along_axis(rank, home[nearest(test, train, min(k, len(train) - 1))], axis=1)
    probes = int(np.quantile(found, RECALL, method="higher")) + 1
    return {"w": w, "b": b, "probes": np.array(probes)}


def _pack(model: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as f:
        return dict(f)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL").where(fine)
    rows = settle(rows.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))), "vectors")
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (most["d"] if most else 0))


def classes_of(rows: DataFrame, k: int, is_query: Column) -> DataFrame:
    """``cid, v, ids, asks``: equal vectors together, with their ``k + 1`` smallest ids; ``cid`` is the smallest."""
    line = W.partitionBy("v").orderBy("vec_id")
    few = rows.dropDuplicates(["v", "vec_id"]).withColumn("i", F.row_number().over(line)).where(F.col("i") <= k + 1)
    ids = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asks = rows.groupBy("v").agg(F.max(is_query).alias("asks"))
    return ids.join(asks, "v").select(F.col("ids")[0].alias("cid"), "v", "ids", "asks")


def fit(classes: DataFrame, n: int, k: int, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """The index, learned by one task from the ``sample`` classes of least hash."""
    # A small table is one partition: too few vectors could be held out to measure the routing.
    parts = 1 if n < FEW * PER_PARTITION else 1 << max(2, round(np.log2(min(MOST, n / PER_PARTITION))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        if got:
            rows = pd.concat(got)
            yield pd.DataFrame({"model": [_pack(fit_sample(np.stack(rows["v"].to_numpy()), parts, k))]})

    chosen = classes.select("v", F.xxhash64("cid").alias("h")).orderBy("h").limit(sample).select("v")
    found = chosen.coalesce(1).mapInPandas(run, "model binary").first()
    return _unpack(found["model"]) if found else {"w": np.zeros((1, 1)), "b": np.zeros(1), "probes": np.array(1)}


def _routed(model: dict[str, np.ndarray], probes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                s = unit(np.stack(batch["v"].to_numpy())) @ model["w"] + model["b"]
                order = np.argsort(-s, axis=1, kind="stable")[:, :probes].astype(np.int32)
                yield batch.assign(parts=list(order))

    return run


def _ranked(k: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ask = rows["ask"].to_numpy(bool)
        points, queries = rows[~ask], rows[ask]
        none = pd.DataFrame({"query": [], "cid": [], "score": []}).astype({"query": "int64", "cid": "int64", "score": "float64"})
        if not len(points) or not len(queries):
            return none
        points = points.sort_values("cid")
        x, ids = np.stack(points["v"].to_numpy()).astype(float), points["cid"].to_numpy()
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
        scaled = x / norms[:, None]
        out = []
        for q, v in zip(queries["cid"], queries["v"], strict=True):
            v = np.asarray(v, float)
            length = np.sqrt(np.einsum("i,i->", v, v))
            near = scaled @ (v / length)
            # All that rounding could bring to the top, then the exact measure and order.
            least = np.partition(near, -k)[-k] if len(near) > k else -np.inf
            pick = np.flatnonzero(near >= least - 1e-9)
            s = np.einsum("ij,j->i", x[pick], v) / (norms[pick] * length)
            best = np.lexsort((ids[pick], -s))[:k]
            out.append(pd.DataFrame({"query": q, "cid": ids[pick][best], "score": s[best]}))
        return pd.concat(out)

    return run


def _nearest_in(points: DataFrame, asked: DataFrame, parts: int, k: int) -> DataFrame:
    """``query, cid, score``: the nearest classes of each asked query within the partitions it is asked of."""
    counts = lambda df: {r["part"]: r["n"] for r in df.groupBy("part").agg(F.count("*").alias("n")).collect()}  # noqa: E731  one per partition
    have, want = counts(points), counts(asked)
    blocks = lambda found, size: F.element_at(F.array(*[F.lit(max(1, -(-found.get(p, 0) // size))) for p in range(parts)]), F.col("part") + 1)
    spread = lambda df, own, size, other, osize, ask: df.select(
        "cid", "v", "part", F.lit(ask).alias("ask"),
        F.pmod(F.xxhash64("cid"), blocks(own, size)).cast("int").alias("mine"),
        F.explode(F.sequence(F.lit(0), blocks(other, osize) - 1)).alias("theirs"),
    )
    left = spread(points, have, BLOCK, want, QUERIES, False).withColumnsRenamed({"mine": "pb", "theirs": "qb"})
    right = spread(asked, want, QUERIES, have, BLOCK, True).withColumnsRenamed({"mine": "qb", "theirs": "pb"})
    both = left.unionByName(right)
    return both.groupBy("part", "pb", "qb").applyInPandas(_ranked(k + 1), "query long, cid long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = 5, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row that ``is_query`` (of ``vec_id``) picks."""
    rows = usable(vectors)
    classes = settle(classes_of(rows, k, is_query), "classes")
    n = classes.count()
    model = fit(classes, n, k, sample)
    parts, probes = len(model["b"]), int(model["probes"])
    put = settle(classes.select("cid", "v", "asks").mapInPandas(_routed(model, probes), "cid long, v array<double>, asks boolean, parts array<int>"), "routed")
    points = put.select("cid", "v", F.col("parts")[0].alias("part"))
    near = _nearest_in(points, put.where("asks").select("cid", "v", F.explode("parts").alias("part")), parts, k)
    near = settle(near, "nearest")
    # Queries whose partitions hold too little are sent to all of them.
    sizes = near.join(classes.select("cid", F.size("ids").alias("n")), "cid").groupBy("query").agg(F.sum("n").alias("n"))
    enough = sizes.where(F.col("n") >= min(k + 1, rows.select("vec_id").distinct().count())).select(F.col("query").alias("cid"))
    short = settle(put.where("asks").select("cid", "v").join(enough, "cid", "left_anti"), "short")
    if parts > 1 and short.count():
        everywhere = short.select("cid", "v", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        near = near.unionByName(_nearest_in(points, everywhere, parts, k)).distinct()
    line = W.partitionBy("query").orderBy(F.desc("score"), "cid")
    best = near.withColumn("i", F.row_number().over(line)).where(F.col("i") <= k + 1).drop("i")
    ids = classes.select("cid", "ids")
    lists = best.join(ids, "cid").groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    lists = settle(lists.join(classes.select(F.col("cid").alias("query"), F.xxhash64("v").alias("h"), "v"), "query").select("h", "v", "found"), "found")
    asks = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("h"), "v").dropDuplicates(["query_id", "v"])
    every = asks.join(lists, ["h", "v"]).select("query_id", F.inline("found")).select("query_id", "score", F.explode("ids").alias("vec_id"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = every.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "vec_id", "score")


def op3_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
