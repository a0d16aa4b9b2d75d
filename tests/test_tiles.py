"""Products against brute force, on shapes that force every path: several blocks, dealt keys, a user
who rated everything, an item everybody rated, zero vectors, exact ties."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palate.operators import content, neighbors, products, ranking, tiles
from palate.operators.favorites import recommend_near_items
from palate.operators.ratings import with_norms
from palate.session import settle


def skewed_ratings(n_users=60, n_items=45, seed=3):
    """User 0 rated every item and every user rated item 0: both own a large share of the rows."""
    rng = np.random.default_rng(seed)
    m = np.where(rng.random((n_users, n_items)) < 0.08, rng.integers(1, 11, (n_users, n_items)) / 2, 0)
    m[0, :] = rng.integers(1, 11, n_items) / 2
    m[:, 0] = rng.integers(1, 11, n_users) / 2
    return m


def as_entries(spark, m):
    rows = [(int(u), int(i), float(m[u, i])) for u, i in zip(*np.nonzero(m), strict=True)]
    return spark.createDataFrame(rows, "userId BIGINT, movieId BIGINT, rating DOUBLE")


def brute_neighbors(m, k, shrink=None):
    norms = np.sqrt((m * m).sum(axis=0))
    overlap = (m > 0).astype(float).T @ (m > 0)
    sim = (m.T @ m) / np.outer(norms, norms)
    if shrink is not None:
        sim = sim * overlap / (overlap + shrink)
    out = {}
    for i in range(m.shape[1]):
        near = [(-round(sim[i, j], 6), j) for j in range(m.shape[1]) if j != i and overlap[i, j] > 0]
        out[i] = [(j, -s) for s, j in sorted(near)[:k]]
    return out


def collected(df, owner="movieId", other="neighborId", score="similarity"):
    out = {}
    for r in df.orderBy(owner, "rank").collect():
        out.setdefault(r[owner], []).append((r[other], r[score]))
    return out


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key, pairs in want.items():
        assert [p[0] for p in got[key]] == [p[0] for p in pairs], key
        assert [p[1] for p in got[key]] == pytest.approx([p[1] for p in pairs], abs=1e-9)


@pytest.mark.parametrize("cell", [10_000, 100, 9])
@pytest.mark.parametrize("shrink", [None, 100.0])
def test_co_ratings_equal_brute_force(spark, cell, shrink):
    """``cell`` lets no user, the busiest one, or most users be dealt in parts."""
    m = skewed_ratings()
    pairs = products.self_product(with_norms(as_entries(spark, m)), cell=cell)
    rows = pairs.collect()
    overlap = (m > 0).astype(int).T @ (m > 0)
    assert {(r.movieId, r.neighborId): r.overlap for r in rows} == {
        (i, j): overlap[i, j] for i in range(m.shape[1]) for j in range(i + 1, m.shape[1]) if overlap[i, j]
    }
    assert all(r.dot == pytest.approx(m[:, r.movieId] @ m[:, r.neighborId]) for r in rows)
    scored = pairs.select("movieId", "neighborId", F.round(products.cosine("dot", shrink), 6).alias("similarity"))
    back = scored.select(F.col("neighborId").alias("movieId"), F.col("movieId").alias("neighborId"), "similarity")
    ranked = neighbors._ranked(scored.unionByName(back), 5)
    assert_same(collected(ranked), brute_neighbors(m, 5, shrink))


def test_entry_neighbors(spark):
    m = skewed_ratings(seed=9)
    assert_same(collected(neighbors.entry_neighbors(as_entries(spark, m), 4)), brute_neighbors(m, 4))


def test_a_user_who_rated_a_third_is_spread(spark):
    """The busiest user's pairs of items are formed by many tasks, none of which gets most of them."""
    rows = [(0, i, 1.0) for i in range(400)] + [(u, (u * 7 + i) % 400, 2.0) for u in range(1, 200) for i in range(4)]
    entries = with_norms(spark.createDataFrame(rows, "userId BIGINT, movieId BIGINT, rating DOUBLE"))
    counts = entries.groupBy("userId").agg(F.count("*").alias("__ln")).withColumn("__rn", F.col("__ln"))
    tasks, heavy, _ = products._plan(counts, "userId", 2500)
    assert [(r.userId, r["__l"], r["__r"]) for r in heavy.collect()] == [(0, 8, 8)]
    dealt = products._dealt(entries, "userId", "movieId", heavy, "__l", "__l", "__a", "__b").where("__a <= __b")
    cells = dealt.where("userId = 0").groupBy("__a", "__b").count().collect()
    assert len(cells) == 8 * 9 // 2 and max(r["count"] for r in cells) < 100
    got = products.self_product(entries, cell=2500)
    assert got.count() == 400 * 399 // 2


def test_shuffled_rows_stay_below_the_products(spark):
    """What leaves the tasks of the join are partial sums: at most one row per product formed."""
    m = skewed_ratings()
    entries = settle(with_norms(as_entries(spark, m)), "test")
    pairs = products.self_product(entries)
    assert pairs.count() <= sum(d * (d - 1) // 2 for d in (m > 0).sum(axis=1))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"partial_sum", plan) and "CartesianProduct" not in plan and "Python" not in plan


def test_tasks_follow_the_number_of_products(spark, monkeypatch):
    monkeypatch.setattr(products, "PER_TASK", 50)
    m = skewed_ratings()
    counts = as_entries(spark, m).groupBy("userId").agg(F.count("*").alias("__ln")).withColumn("__rn", F.col("__ln"))
    tasks, heavy, _ = products._plan(counts, "userId", 10_000)
    assert heavy is None and tasks == -(-int(((m > 0).sum(axis=1) ** 2).sum()) // 50)


@pytest.mark.parametrize("cell, sent", [(10_000, 0), (60, 0), (60, 1000)])
def test_product_with_a_hot_inner_key(spark, monkeypatch, cell, sent):
    """Joined by key, with the key dealt in parts, and with the left side sent to all tasks."""
    monkeypatch.setattr(products, "SENT_ROWS", sent)
    rng = np.random.default_rng(5)
    w = np.where(rng.random((30, 20)) < 0.2, rng.integers(1, 4, (30, 20)), 0).astype(float)
    w[:, 0] = 1  # one seed everybody likes
    s = np.where(rng.random((20, 50)) < 0.3, rng.random((20, 50)).round(3), 0)
    s[0, :] = rng.random(50).round(3)
    left = spark.createDataFrame(
        [(int(q), int(n), float(w[q, n])) for q, n in zip(*np.nonzero(w), strict=True)],
        "queryId BIGINT, inner BIGINT, x DOUBLE",
    )
    right = spark.createDataFrame(
        [(int(n), int(i), float(s[n, i])) for n, i in zip(*np.nonzero(s), strict=True)],
        "inner BIGINT, id BIGINT, y DOUBLE",
    )
    barred = {(q, i) for q in range(30) for i in range(50) if rng.random() < 0.4}
    exclude = spark.createDataFrame(sorted(barred), "queryId INT, id INT")
    got = products.product_top_k(left, right, 6, exclude, cell=cell)
    score = np.round(w @ s, 6)
    want = {}
    for q in range(30):
        ranked = sorted((-score[q, i], i) for i in range(50) if (q, i) not in barred and score[q, i])
        want[q] = [(i, -v) for v, i in ranked[:6]]
    assert_same(collected(got, "queryId", "id", "score"), want)
    overlap = (w > 0).astype(int) @ (s > 0)
    plain = {(r.queryId, r.id): r.overlap for r in products.product(left, right, exclude, cell=cell).collect()}
    assert plain == {(q, i): overlap[q, i] for q in range(30) for i in range(50) if overlap[q, i] and (q, i) not in barred}


def test_sums_of_a_small_left_side_are_not_shuffled(spark):
    left = settle(spark.createDataFrame([(1, 2, 1.0), (2, 2, 2.0)], "queryId BIGINT, inner BIGINT, x DOUBLE"), "test")
    right = settle(spark.range(100).selectExpr("2L AS inner", "id", "CAST(id AS DOUBLE) AS y"), "test")
    plan = products.product(left, right)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("k", [1, 7, 300])
def test_top_k_of_many_equals_a_plain_sort(spark, k):
    rng = np.random.default_rng(k)
    rows = [(int(rng.integers(0, 4)), i, float(np.round(rng.random(), 2))) for i in range(3000)] + [(9, 1, 0.5), (9, 2, 0.5)]
    df = spark.createDataFrame(rows, "q INT, id INT, score DOUBLE")
    got = sorted(map(tuple, ranking.top_k_of_many(df, "q", "score", "id", k).collect()))
    want = sorted(map(tuple, ranking.top_k_per(df, "q", [F.desc("score"), F.asc("id")], k).select("q", "id", "score", "rank").collect()))
    assert got == want


def test_empty_products(spark):
    left = spark.createDataFrame([], "queryId BIGINT, inner BIGINT, x DOUBLE")
    right = spark.createDataFrame([(1, 2, 3.0)], "inner BIGINT, id BIGINT, y DOUBLE")
    assert products.product_top_k(left, right, 3).count() == 0
    assert products.self_product(spark.createDataFrame([], "userId INT, movieId INT, rating DOUBLE, norm DOUBLE")).count() == 0


def vectors(n=70, d=6, seed=1):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d)).astype(np.float32)
    m[3] = 0.0
    m[7] = m[8] = m[9]
    return m


def factor_table(spark, m):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(m)], "id INT, features ARRAY<FLOAT>"
    )


def cosines(m):
    m = m.astype(np.float64)
    lengths = np.linalg.norm(m, axis=1)
    lengths[lengths == 0] = 1
    unit = m / lengths[:, None]
    return np.round(unit @ unit.T, 6)


@pytest.mark.parametrize("blocks", [{}, {"query_blocks": 3, "item_blocks": 4}])
def test_factor_neighbors(spark, blocks):
    m = vectors()
    sim = cosines(m)
    want = {}
    for i in range(len(m)):
        want[i] = [(j, -s) for s, j in sorted((-sim[i, j], j) for j in range(len(m)) if j != i)[:5]]
    got = collected(neighbors.factor_neighbors(factor_table(spark, m), 5, **blocks))
    assert_same(got, want)


def test_more_neighbors_asked_than_items_exist(spark):
    m = vectors(n=12)
    got = collected(neighbors.factor_neighbors(factor_table(spark, m), 50))
    assert all(len(v) == 11 and i not in [j for j, _ in v] for i, v in got.items())


@pytest.mark.parametrize("blocks", [{}, {"query_blocks": 5, "item_blocks": 3}])
def test_favorites_take_the_best_vector(spark, blocks):
    m = vectors()
    sim = cosines(m)
    liked = {0: [1, 2, 3], 1: [7], 2: [50, 999]}
    table = spark.createDataFrame(
        [(q, i) for q, items in liked.items() for i in items], "queryId INT, movieId INT"
    )
    got = collected(recommend_near_items(table, factor_table(spark, m), 6, **blocks), "queryId", "movieId", "score")
    want = {}
    for q, items in liked.items():
        known = [i for i in items if i < len(m)]
        ranked = sorted((-max(sim[i, j] for i in known), j) for j in range(len(m)) if j not in items)
        want[q] = [(j, -s) for s, j in ranked[:6]]
    assert_same(got, want)


def test_lsh_is_a_subset_of_the_exact_pairs(spark):
    m = vectors(n=300, d=8, seed=4)
    factors = factor_table(spark, m)
    exact = {
        (r["movieId"], r["neighborId"]): r["similarity"]
        for r in neighbors.radius_pairs(factors, 0.6, bucket_rows=64).collect()
    }
    sim = cosines(m)
    near = {(i, j) for i in range(300) for j in range(300) if i != j and sim[i, j] > 0.6}
    assert {p for p in near if abs(sim[p] - 0.6) > 1e-5} <= exact.keys()
    found = neighbors.lsh_neighbors(factors, 300, cos_threshold=0.6, bucket_rows=32).collect()
    pairs = {(r["movieId"], r["neighborId"]): r["similarity"] for r in found}
    assert pairs.items() <= exact.items()
    assert len(pairs) >= 0.9 * len(exact)
    coarse = neighbors.lsh_neighbors(factors, 300, cos_threshold=0.6, bucket_rows=10_000).collect()
    assert {(r["movieId"], r["neighborId"]) for r in coarse} == pairs.keys()


def test_lsh_matches_the_library_join(spark):
    from pyspark.ml.feature import BucketedRandomProjectionLSH

    from palate.functions.vectors import radius_for_cosine, with_unit_vector

    factors = factor_table(spark, vectors(n=120, d=8, seed=6))
    unit = with_unit_vector(factors, "features", "unit_vec")
    lsh = BucketedRandomProjectionLSH(
        inputCol="unit_vec", outputCol="hashes", bucketLength=1.2, numHashTables=3, seed=42
    )
    model = lsh.fit(unit)
    joined = model.approxSimilarityJoin(unit, unit, radius_for_cosine(0.6), "dist").select(
        F.col("datasetA.id").alias("a"), F.col("datasetB.id").alias("b")
    )
    want = {(r["a"], r["b"]) for r in joined.where("a <> b").collect()}
    got = neighbors.lsh_neighbors(factors, 120, cos_threshold=0.6).collect()
    assert {(r["movieId"], r["neighborId"]) for r in got} == want


def test_method_choice(spark):
    factors = factor_table(spark, vectors(n=40))
    auto = collected(neighbors.precompute_neighbors(factors, 3))
    assert auto == collected(neighbors.factor_neighbors(factors, 3))
    with pytest.raises(ValueError):
        neighbors.precompute_neighbors(factors, 3, method="driver")


def test_hybrid_places_new_items_by_genre(spark, movies):
    factors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id INT, features ARRAY<FLOAT>")
    profiles = content.item_profiles(factors, movies)
    best = collected(content.hybrid_neighbors(profiles, 1, factor_weight=0.5), score="score")
    assert best[4] == [(3, pytest.approx(0.5 * 2 / 3, abs=1e-6))]
    assert best[1] == [(2, pytest.approx(0.5 * 3 / 5, abs=1e-6))]


def test_hybrid_equals_brute_force_for_any_vocabulary(spark):
    """Tags that everybody has, tags of one item alone, repeated and null tags, empty and null lists."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        tags = ["all"] * (i % 4 > 0) + [f"t{x}" for x in rng.integers(0, 12, i % 5)] + [f"only{i}"] * (i % 3)
        rows.append((i, rng.standard_normal(4).round(3).tolist() if i % 7 else [0.0] * 4, None if i % 50 == 9 else [*tags, *([None] * (i % 11 == 0))]))
    profiles = spark.createDataFrame(rows, "id INT, features ARRAY<DOUBLE>, tags ARRAY<STRING>")
    unit = np.array([np.array(f) / (np.linalg.norm(f) or 1.0) for _, f, _ in rows])
    sets = [set(t or ()) for *_, t in rows]
    alike = np.array([[len(a & b) / len(a | b) if a | b else 0.0 for b in sets] for a in sets])
    want = np.round(0.6 * (unit @ unit.T) + 0.4 * alike, 6)
    for blocks in ({}, {"query_blocks": 3, "item_blocks": 2}):
        got = collected(content.hybrid_neighbors(profiles, 5, factor_weight=0.6, **blocks), score="score")
        for i in range(300):
            best = sorted((-want[i, j], j) for j in range(300) if j != i)[:5]
            assert [s for _, s in got[i]] == pytest.approx([-s for s, _ in best], abs=2e-6)


def test_shared_tags_need_no_room_per_tag():
    """A block of 2 000 rows with 100 000 different tags: dense rows would take 1.6 GB."""
    n = 2000
    tags = pa.table({"tags": pa.array([[f"{i}-{j}" for j in range(50)] + ["all"] for i in range(n)])})
    lists = tiles._tag_postings(tags, tags)
    tracemalloc.start()
    got = tiles._jaccard(*lists, 100, 200, n)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 60_000_000
    assert got.shape == (200, n) and got[0, 100] == 1.0 and got[0, 0] == pytest.approx(1 / 101)


def test_blocks_hold_bytes_not_few_rows():
    assert tiles.rows_per_block(50) > 16 * 4096 - 1 and tiles.rows_per_block(64) == tiles.BLOCK_ROWS
    assert 1024 <= tiles.rows_per_block(100_000) < tiles.rows_per_block(1000) < tiles.rows_per_block(64)


@pytest.mark.parametrize("keep", [1, 7])
def test_few_cells_hold_the_best(keep):
    rng = np.random.default_rng(keep)
    scores = np.round(rng.random((9, 1500)), 2)  # many ties
    rows, cols = tiles._best_cells(scores, np.full(9, keep))
    for r in range(9):
        want = sorted(range(1500), key=lambda c: (-scores[r, c], c))[:keep]
        assert cols[rows == r].tolist() == want
    few = tiles._few_cells(scores, keep, 6)
    assert len(few[0]) < scores.size / 4
    scores[3, 5] = np.nan
    assert tiles._few_cells(scores, keep, 6) is None


def test_radius_pairs_are_not_shuffled(spark):
    rows = [(i % 40, [float(i % 7), 1.0, float(i % 3)]) for i in range(80)]  # every id twice
    factors = spark.createDataFrame(rows, "id BIGINT, features ARRAY<DOUBLE>")
    found = neighbors.radius_pairs(factors, 0.3, bucket_rows=16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan
    got = [tuple(r)[:2] for r in found.collect()]
    assert got and len(got) == len(set(got))


def test_a_favourite_is_multiplied_once_for_all(spark, monkeypatch):
    from palate.operators import favorites

    asked = []
    real = favorites.vector_top_k
    monkeypatch.setattr(favorites, "vector_top_k", lambda q, *a, **o: asked.append(q.count()) or real(q, *a, **o))
    factors = spark.createDataFrame([(i, [1.0, float(i), float(i * i % 7)]) for i in range(30)], "id BIGINT, features ARRAY<DOUBLE>")
    liked = spark.createDataFrame([(q, q % 3) for q in range(90)], "queryId BIGINT, movieId BIGINT")
    assert favorites.recommend_near_items(liked, factors, 4).count() == 360
    assert asked == [3]


@pytest.mark.parametrize("one_side", [True, False])
def test_a_full_bucket_keeps_only_the_best_pairs(monkeypatch, one_side):
    """Where all vectors of a bucket are near, a tile holds few pairs at once, and the same come out."""
    rng = np.random.default_rng(2)
    m = tiles._unit(1.0 + 0.1 * rng.random((1500, 6)))
    side = np.where(np.arange(1500) < 700, 0, 2) if not one_side else np.ones(1500, int)
    table = pa.table({"side": side, "id": np.arange(1500), "unit": pa.array(list(m))})
    want = neighbors._bucket_tile(3, 1.0)(table)
    monkeypatch.setattr(neighbors, "HELD_PAIRS", 20_000)
    most, real = [], neighbors._nearest
    monkeypatch.setattr(neighbors, "_nearest", lambda found, n: most.append(sum(len(x[0]) for x in found)) or real(found, n))
    monkeypatch.setattr(neighbors, "max", lambda *a: min(20, max(*a)), raising=False)  # strips of a few rows
    got = neighbors._bucket_tile(3, 1.0)(table)
    assert len(most) > 5 and max(most) < 200_000
    assert got.select(["movieId", "neighborId"]).equals(want.select(["movieId", "neighborId"])) and got.num_rows == 3 * 1500
    assert np.allclose(got["similarity"], want["similarity"], atol=1e-9)
    squared = m @ m.T if one_side else np.where((np.arange(1500) < 700)[:, None] != (np.arange(1500) < 700)[None, :], m @ m.T, -1.0)
    np.fill_diagonal(squared, -1.0)
    near = {(i, int(j)) for i in range(1500) for j in np.lexsort((np.arange(1500), -np.round(squared[i], 6)))[:3]}
    assert {*zip(got["movieId"].to_pylist(), got["neighborId"].to_pylist(), strict=True)} == near
