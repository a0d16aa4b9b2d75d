import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from corpus_fixtures import prose
from pyspark.sql import functions as F

from palate.llm import neighbors, sharding


def check_shards(rows, docs, shards=16):
    assert len(rows) == len(docs)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    return [sizes[s] for s in range(shards)]


def test_bytes_are_near_equal_and_copies_stay_together(spark):
    r = random.Random(1)
    docs = [(i, prose(i % 1500, r.choice([5, 20, 60, 300])) if i % 5 else "a copy") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sharding.shard(df).collect()
    sizes = check_shards(rows, docs)
    assert max(sizes) - min(sizes) <= 0.02 * np.mean(sizes)
    text = dict(docs)
    homes = defaultdict(set)
    for x in rows:
        assert x.size == len(text[x.doc_id].encode()) + 1 and x.text_crc32 == zlib.crc32(text[x.doc_id].encode())
        homes[text[x.doc_id]].add(x.shard)
    # The copies are a fifth of all rows, more than a shard's share, so they alone are split.
    assert all(len(h) == 1 for t, h in homes.items() if t != "a copy") and len(homes["a copy"]) > 1
    again = sharding.shard(df.repartition(7)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_a_hot_text_of_most_bytes_is_spread(spark):
    hot = prose(0, 400)
    docs = [(i, hot if i % 2 else prose(i, 20)) for i in range(2000)]
    sizes = check_shards(sharding.shard(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
    assert max(sizes) - min(sizes) <= 0.06 * np.mean(sizes)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_a_hot_text_whose_rows_share_an_id_is_spread(spark, doc_id):
    """Half of all rows, and most bytes, are one text of one id, or of none."""
    hot = prose(0, 400)
    docs = [(doc_id if i % 2 else i, hot if i % 2 else prose(i, 20)) for i in range(4000)]
    sizes = check_shards(sharding.shard(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
    assert max(sizes) - min(sizes) <= 0.06 * np.mean(sizes)


def test_packing_equals_a_plain_greedy_one():
    """By the definition, one lot at a time: the largest first, to the best dot product among the shards it fits."""
    r = random.Random(3)
    lots = [[900 * r.random(), 90 * r.random(), 9 * r.random()] for _ in range(300)]  # no two alike, so no ties
    total = [sum(x) for x in zip(*lots, strict=True)]
    left = [[t / 8 for t in total] for _ in range(8)]
    want = {}
    for i in sorted(range(300), key=lambda i: (-lots[i][0], -sum(lots[i][d] / total[d] for d in range(3)), i)):
        fits = [s for s in range(8) if left[s][0] >= lots[i][0]]
        worth = lambda s: sum(left[s][d] * lots[i][d] / total[d] ** 2 for d in range(3))  # noqa: B023, E731
        best = max(fits, key=worth) if fits else max(range(8), key=lambda s: left[s][0])
        want[i] = best
        for d in range(3):
            left[best][d] -= lots[i][d]
    assert sharding.place(np.array(lots, float), 8).tolist() == [want[i] for i in range(300)]


def test_odd_rows(spark, odd, none):
    rows = sharding.shard(odd)
    assert set(rows.columns) >= {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "kept", "n_chars"}
    check_shards(rows.collect(), odd.collect())
    assert {r.size for r in rows.where("doc_id = 4").collect()} == {1}
    assert sharding.shard(none).count() == 0


def brute(vectors, k=5):
    ok = {i: np.array(v, float) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in ok.items():
        if q % 50 == 0:
            s = sorted(((-round(float(v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))), 12), i) for i, w in ok.items() if i != q))
            out[q] = [i for _, i in s[:k]]
    return out


def found(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append(r.vec_id)
    return dict(out)


SCHEMA = "vec_id long, embedding array<float>, rank int"


def test_odd_vectors_and_ties(spark):
    rows = [(i, [1.0, 0.0, float(i % 3)], 1) for i in range(120)]
    rows += [(200, None, 1), (250, [0.0, 0.0, 0.0], 1), (300, [1.0, None, 2.0], 1), (350, [float("nan"), 1.0, 1.0], 1),
             (400, [float("inf"), 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], None), (450, [1.0, 2.0], 1), (500, [-0.0, 0.0, 3.0], 1), (0, rows[0][1], 1)]
    got = found(neighbors.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    assert got == brute([r[:2] for r in rows[:-1] if r[0] != 450])


def test_few_candidates_and_none(spark):
    q = F.col("vec_id") % 50 == 0
    got = found(neighbors.search(spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [2.0, 1.0], 1), (50, [3.0, 1.0], 1)], SCHEMA), q))
    assert got == {0: [1, 50], 50: [1, 0]}
    assert neighbors.search(spark.createDataFrame([(0, [1.0], 1)], SCHEMA), q).count() == 0
    assert neighbors.search(spark.createDataFrame([], SCHEMA), q).count() == 0


@pytest.mark.parametrize("n", [20, 100, 600])
def test_small_tables_at_the_defaults_equal_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(12)], 1) for i in range(n)]
    got = found(neighbors.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    assert got == brute([r[:2] for r in rows])


def test_queries_whose_partitions_hold_too_little_get_the_others(spark, monkeypatch):
    def lonely(x, parts, k):
        """A classifier that sends one vector to a partition of its own, and all queries to one partition."""
        w = np.zeros((x.shape[1], 2))
        w[0] = [1.0, -1.0]
        return {"w": w, "b": np.zeros(2), "probes": np.array(1)}

    monkeypatch.setattr(neighbors, "fit_sample", lonely)
    rows = [(i, [-1.0 if i == 50 else 1.0, float(i), 2.0], 1) for i in range(120)]
    got = found(neighbors.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    assert got == brute([r[:2] for r in rows])


def test_recall_with_a_common_vector(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((40, 16))
    rows = [(i, (centers[i % 40] + 0.4 * rng.standard_normal(16)).tolist() if i % 3 else [1.0] * 16, 1) for i in range(6000)]
    rows = [(i, [float(np.float32(x)) for x in v], n) for i, v, n in rows]
    got = found(neighbors.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, sample=2000))
    want = brute([r[:2] for r in rows])
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    assert all(got[q] == want[q] for q in want if q % 3 == 0)  # ties among equal vectors


def test_partitions_of_the_graph_are_equal():
    rng = np.random.default_rng(1)
    x = neighbors.unit(rng.standard_normal((1000, 8)))
    graph = neighbors.nearest(x, x, 10, skip_self=True)
    part = neighbors.bisect(graph, 8, rng)
    assert sorted(np.bincount(part)) == [125] * 8
    inside = (part[graph] == part[:, None]).mean()
    assert inside > 0.3  # by chance: 0.125
