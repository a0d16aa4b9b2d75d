"""Properties a factor model must have; its exact numbers depend on partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.operators import als, evaluate, explain, scoring
from palate.operators import ratings as rt
from palate.session import settle
from palate.sources import readers, writers


@pytest.fixture(scope="module")
def planted(spark):
    """300 x 200 ratings of rank 4, a fifth of them observed."""
    rng = np.random.default_rng(0)
    full = rng.random((300, 4)) @ rng.random((200, 4)).T
    rows = [
        (u, i, float(full[u, i] * 2.5))
        for u in range(300)
        for i in range(200)
        if rng.random() < 0.2
    ]
    return spark.createDataFrame(rows, "userId INT, movieId INT, rating DOUBLE").cache()


@pytest.fixture(scope="module")
def fitted(planted):
    train, val = rt.hash_split(planted)
    return als.fit_and_score(train, val, als.AlsSettings(rank=4, reg=0.02, max_iter=8))


def test_beats_the_mean_on_structured_data(planted, fitted):
    _, error = fitted
    mean_error = evaluate.mean_predictor_rmse(*rt.hash_split(planted)).first()["rmse"]
    assert error < 0.5 * mean_error


def test_rmse_agrees_with_the_aggregate(planted, fitted):
    model, error = fitted
    _, val = rt.hash_split(planted)
    table = evaluate.rmse_table(als.predict(model, val)).first()
    assert table["rmse"] == pytest.approx(error, abs=1e-5)


def test_unknown_pairs_are_dropped_and_empty_is_none(spark, fitted):
    model, _ = fitted
    strangers = spark.createDataFrame([(9999, 1, 3.0), (1, 9999, 3.0)], "userId INT, movieId INT, rating DOUBLE")
    assert als.predict(model, strangers).isEmpty()
    assert als.rmse(als.predict(model, strangers)) is None
    assert evaluate.rmse_table(als.predict(model, strangers)).first()["rmse"] is None


def test_lists_are_ranked_and_complete(spark, fitted):
    model, _ = fitted
    users = spark.createDataFrame([(1,), (2,), (5000,)], "userId INT")
    rows = als.recommend_users(model, users, 7).orderBy("userId", "rank").collect()
    assert {r["userId"] for r in rows} == {1, 2}
    for user in (1, 2):
        mine = [r for r in rows if r["userId"] == user]
        assert [r["rank"] for r in mine] == list(range(1, 8))
        assert len({r["movieId"] for r in mine}) == 7
        scores = [r["score"] for r in mine]
        assert scores == sorted(scores, reverse=True)
    everyone = als.recommend_everyone(model, 7)
    assert everyone.groupBy("userId").count().where("count <> 7").isEmpty()
    same = everyone.where("userId = 1").orderBy("rank").collect()
    assert [r["movieId"] for r in same] == [r["movieId"] for r in rows if r["userId"] == 1]


def test_lists_equal_the_library(spark, fitted):
    model, _ = fitted
    theirs = als.flat(model.recommendForAllUsers(9))
    ours = als.recommend_everyone(model, 9)
    both = ours.alias("a").join(theirs.alias("b"), ["userId", "rank"])
    assert both.count() == ours.count() == theirs.count()
    assert both.where(F.abs(F.col("a.score") - F.col("b.score")) > 1e-5).isEmpty()
    differing = both.where(F.col("a.movieId") != F.col("b.movieId")).count()
    assert differing <= 0.001 * both.count()  # float ties only
    again = als.flat(als.nested(ours))
    assert again.select("userId", "movieId", "rank").exceptAll(ours.select("userId", "movieId", "rank")).isEmpty()


def test_nulls_are_cleaned_before_training(spark, planted):
    dirty = planted.limit(2000).unionByName(
        spark.createDataFrame([(None, 1, 3.0), (1, None, 3.0), (1, 2, None)], "userId INT, movieId INT, rating DOUBLE")
    )
    assert als.fit(dirty, als.AlsSettings(rank=2, max_iter=1)).rank == 2


def test_grid_keeps_the_best(spark, planted, tmp_path):
    train, val = rt.hash_split(planted)
    outcome = als.grid_search(train, val, (2, 4), (0.02, 1.0), als.AlsSettings(max_iter=4), parallel=2)
    rows = outcome.results.orderBy("seq").collect()
    assert [(r["rank"], r["regParam"]) for r in rows] == [(2, 0.02), (2, 1.0), (4, 0.02), (4, 1.0)]
    assert outcome.rmse == min(r["rmse"] for r in rows)
    best = evaluate.best_setting(outcome.results).first()
    assert (best["rank"], best["regParam"]) == (outcome.settings.rank, outcome.settings.reg)
    writers.write_grid(outcome.results, str(tmp_path / "grid"))
    assert spark.read.json(str(tmp_path / "grid")).count() == 4


def test_grid_without_scorable_rows_says_so(planted):
    with pytest.raises(ValueError, match="could be scored"):
        als.grid_search(planted, planted.where("userId < 0"), (2,), (0.1,), als.AlsSettings(max_iter=1))


def test_best_setting_ignores_nan_and_breaks_ties_by_order(spark):
    rows = [(0, 2, 0.1, float("nan")), (1, 4, 0.1, 0.5), (2, 8, 0.1, 0.5), (3, 8, 0.2, None)]
    results = spark.createDataFrame(rows, "seq INT, rank INT, regParam DOUBLE, rmse DOUBLE")
    assert evaluate.best_setting(results).first()["seq"] == 1
    assert evaluate.best_setting(results.where("seq = 0")).isEmpty()


def test_model_round_trip(spark, fitted, tmp_path):
    model, _ = fitted
    path = str(tmp_path / "model")
    assert readers.load_als_or_none(spark, path) is None
    writers.write_model(model, path)
    writers.write_model(model, path)
    again = readers.load_als_or_none(spark, path)
    assert again.itemFactors.count() == model.itemFactors.count()
    with pytest.raises(Exception):
        readers.load_als(str(tmp_path / "nothing"))


def test_training_is_repeatable(planted):
    settings = als.AlsSettings(rank=3, max_iter=2)
    a = als.fit(planted, settings).itemFactors.orderBy("id").collect()
    b = als.fit(planted, settings).itemFactors.orderBy("id").collect()
    assert a == b


def test_implicit_mode(planted):
    settings = als.AlsSettings(rank=3, max_iter=2, implicit=True, alpha=2.0)
    model = als.fit(planted, settings)
    assert not als.recommend_everyone(model, 3).isEmpty()


def test_explanations_equal_brute_force(spark):
    """A user with most of the history, a favourite without factors, a zero vector, a null one, ties, repeated rows."""
    rng = np.random.default_rng(4)
    vectors = {i: rng.standard_normal(6).round(3).tolist() for i in range(60)}
    vectors |= {5: [0.0] * 6, 6: vectors[4], 7: vectors[4]}
    rows = [(0 if i % 2 else i % 25, int(rng.integers(0, 66)), float(rng.integers(2, 11)) / 2) for i in range(500)]
    recs = [(u, int(i)) for u in range(30) for i in rng.choice(62, 5, replace=False)]
    unit = {i: np.array(v) / (np.linalg.norm(v) or 1.0) for i, v in vectors.items()}
    want = set()
    for u, i in recs:
        liked = {m for w, m, r in rows if w == u and r >= 4.0 and m in unit and m != i}
        near = sorted((-round(float(unit[i] @ unit[m]), 6), m) for m in liked) if i in unit else []
        want |= {(u, i, m, n) for n, (_, m) in enumerate(near[:3], 1)}
    history = spark.createDataFrame([*rows, (3, None, 5.0)], "userId INT, movieId INT, rating DOUBLE")
    factors = spark.createDataFrame([*vectors.items(), (65, None)], "id INT, features ARRAY<DOUBLE>")
    asked = spark.createDataFrame([*recs, recs[0]], "userId INT, movieId INT")
    found = explain.explain_by_factors(asked, history, factors).collect()
    got = {(r["userId"], r["movieId"], r["favoriteId"], r["reason_rank"]) for r in found}
    assert len(found) == len(got) and got == want


def test_explanations_are_the_nearest_favorites(spark):
    factors = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [1.0, 0.1])], "id INT, features ARRAY<FLOAT>"
    )
    history = spark.createDataFrame([(7, 2, 5.0), (7, 3, 4.5), (7, 4, 1.0)], "userId INT, movieId INT, rating DOUBLE")
    recs = spark.createDataFrame([(7, 1)], "userId INT, movieId INT")
    rows = explain.explain_by_factors(recs, history, factors, m=5).orderBy("reason_rank").collect()
    assert [r["favoriteId"] for r in rows] == [2, 3]
    assert rows[0]["similarity"] == pytest.approx(0.993884, abs=1e-6)
    assert explain.explain_by_factors(recs, history, factors, m=1).where(F.col("favoriteId") == 2).count() == 1


def test_lists_equal_the_models_own_method(spark):
    ratings = spark.createDataFrame(
        [(u, i, float((u * 7 + i * 3) % 9) / 2 + 0.5) for u in range(30) for i in range(25) if (u + i) % 3],
        "userId INT, movieId INT, rating DOUBLE",
    )
    model = als.fit(ratings, als.AlsSettings(rank=4, max_iter=3))
    mine = {(r.userId, r["rank"]): r.score for r in als.recommend_everyone(model, k=10).collect()}
    own = {(r.userId, r["rank"]): r.score for r in als.flat(model.recommendForAllUsers(10)).collect()}
    assert mine.keys() == own.keys()
    assert all(abs(mine[k] - own[k]) < 1e-4 for k in mine)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ids_beyond_int32_are_an_error(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = spark.createDataFrame([(2**31, 1, 3.0)], "userId LONG, movieId LONG, rating DOUBLE")
        with pytest.raises(Exception, match="beyond 32 bits"):
            als.training_input(rows).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_repeated_pairs_count_once_by_policy(spark, planted):
    settings = als.AlsSettings(rank=3, max_iter=3)
    stamped = planted.withColumn("timestamp", F.lit(5))
    older = stamped.where("userId < 100").withColumns({"rating": F.lit(0.5), "timestamp": F.lit(1)})
    factors = lambda df, s=settings: df.sparkSession.createDataFrame(
        als.fit(df.coalesce(1).sortWithinPartitions("userId", "movieId"), s).itemFactors.orderBy("id").collect()
    ).collect()
    assert als.AlsSettings().policy_for(stamped) == "latest" and als.AlsSettings().policy_for(planted) == "avg"
    assert als.AlsSettings(implicit=True).policy_for(stamped) == "sum"
    rows = lambda df, policy: sorted(map(tuple, als.training_input(df, policy).collect()))
    assert rows(stamped.unionByName(older), "latest") == rows(planted, "avg")
    twice = rows(planted.unionByName(planted), "sum")
    assert [x[2] for x in twice] == pytest.approx([2 * x[2] for x in rows(planted, "avg")])
    assert len(rows(planted.unionByName(planted), "none")) == 2 * len(twice)
    assert len(factors(stamped.unionByName(older))) == 200


def test_ratings_are_folded_once(spark, planted):
    """Whatever the ratings come from runs once, however often the library reads its input; the model is the same."""
    read = spark.sparkContext.accumulator(0)

    def seen(rating):
        read.add(1)
        return rating

    settings = als.AlsSettings(rank=2, max_iter=2)
    told = planted.withColumn("rating", F.udf(seen, "double").asNondeterministic()("rating"))
    model = als.fit(told.unionByName(planted.limit(50)), settings)
    assert read.value == planted.count()
    plain = settings.estimator().fit(als.training_input(planted, "avg"))
    ours, theirs = ({r["id"]: r["features"] for r in m.itemFactors.collect()} for m in (model, plain))
    assert ours.keys() == theirs.keys()
    assert all(ours[i] == pytest.approx(theirs[i], abs=1e-4) for i in ours)


def test_wide_ids(spark, planted, tmp_path):
    from palate.operators import codes

    wide = planted.select((F.col("userId") * -(2**35)).alias("userId"), (F.col("movieId") + 2**40).alias("movieId"), "rating")
    settings = als.AlsSettings(rank=4, reg=0.02, max_iter=8)
    codes.save_coded(codes.fit_coded(wide, settings), str(tmp_path / "m"))
    model = codes.load_coded(spark, str(tmp_path / "m"))
    assert [(r.userId, r.code) for r in model.users.orderBy("code").collect()] == [(-u * 2**35, 299 - u) for u in range(299, -1, -1)]
    error = als.rmse(codes.predict_coded(model, wide.withColumn("prediction_", F.lit(1))))
    assert error < 0.2
    lists = codes.recommend_coded(model, 5, spark.createDataFrame([(-7 * 2**35,), (12,)], "userId LONG")).orderBy("rank").collect()
    assert [r["rank"] for r in lists] == [1, 2, 3, 4, 5] and {r.userId for r in lists} == {-7 * 2**35}
    assert all(2**40 <= r.movieId < 2**40 + 200 for r in lists)
    assert model.item_factors().count() == 200 and model.user_factors().where("id > 0").count() == 0
    strangers = spark.createDataFrame([(5, 2**40, 1.0), (None, None, 2.0)], "userId LONG, movieId LONG, rating DOUBLE")
    assert codes.predict_coded(model, strangers).count() == 0


def test_codes_are_dense_over_many_partitions(spark):
    from palate.operators import codes

    rows = [(i * 7919 % 1000 - 500 if i % 10 else None,) for i in range(3000)]
    got = codes.dense_codes(spark.createDataFrame(rows, "x LONG").repartition(6), "x").orderBy("x").collect()
    assert [(r.x, r.code) for r in got] == [(x, i) for i, x in enumerate(sorted({r[0] for r in rows if r[0] is not None}))]
    assert codes.dense_codes(spark.createDataFrame([], "x LONG"), "x").count() == 0


def test_registered_queries_fit_the_whole_job(spark, monkeypatch):
    from fixtures import DATA

    from palate.plans import registry

    class Fitted(Exception):
        pass

    def stop(ratings, settings=als.AlsSettings()):
        raise Fitted(settings)

    run = lambda name: registry.QUERIES[name](spark, str(DATA / "sf0.001"))
    seen = []
    monkeypatch.setattr(als, "fit_and_score", lambda train, val, s: (seen.append((s.rank, s.reg, s.max_iter)), 1.0))
    assert run("als_grid").count() == 9
    assert sorted(seen) == [(k, g, als.GRID_ITERATIONS) for k in als.GRID_RANKS for g in als.GRID_REGS]
    monkeypatch.setattr(als, "fit", stop)
    for name in ("als_implicit", "als_saved_model", "als_lists_ordered"):
        with pytest.raises(Fitted) as met:
            run(name)
        assert met.value.args[0] == als.AlsSettings(implicit=name == "als_implicit")


def test_stored_pairs_meet_vectors_in_cells(spark, fitted, monkeypatch):
    """The rows of ``predict``, bit by bit, without a vector per pair in any shuffle."""
    model, _ = fitted
    width = model.userFactors.count() + model.itemFactors.count()
    users, items = spark.range(-3, 320).select(F.col("id").alias("userId")), spark.range(-3, 220).select(F.col("id").alias("movieId"))
    twice = spark.createDataFrame([(7, 7), (7, 7)], "userId BIGINT, movieId BIGINT")
    pairs = users.crossJoin(items).unionByName(twice).select(
        "userId", F.when(F.col("movieId") % 5 != 0, F.concat_ws("-", "userId", "movieId")).alias("note"), "movieId", F.array("movieId").alias("list")
    )
    pairs = settle(pairs, "pairs")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        for shape in (None, (1, 1), (3, 4), (5, 1)):
            if shape is not None:
                monkeypatch.setattr(scoring, "grid", lambda *_, s=shape: s)
            scored = als.predict_stored(model, pairs)
            assert "MapInArrow" in scored._jdf.queryExecution().executedPlan().toString()
            told = als.predict(model, pairs)
            assert scored.columns == told.columns and scored.dtypes == told.dtypes
            assert scored.exceptAll(told).isEmpty() and told.exceptAll(scored).isEmpty()
            assert told.count() > 20 * width
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    few = pairs.where("userId = 7")
    assert "MapInArrow" not in als.predict_stored(model, few)._jdf.queryExecution().executedPlan().toString()
    assert als.predict_stored(model, pairs.where("false")).isEmpty()
    for way in (als.predict, als.predict_stored):
        with pytest.raises(Exception, match="(?i)null"):
            way(model, pairs.withColumn("userId", F.expr("nullif(userId, 7)"))).collect()


def test_grid_bounds_cells_and_prefers_few_copies():
    assert scoring.grid(10, 10, 50, 1) == (1, 1)
    parts, blocks = scoring.grid(900_000, 1_200_000, 50, 12)
    assert parts * blocks >= 12
    assert scoring.copies(900_000, 1_200_000, (parts, blocks)) <= scoring.copies(900_000, 1_200_000, (12, 1))
    parts, blocks = scoring.grid(5_400_000, 7_200_000, 50, 12)
    assert 7_200_000 * 224 / blocks <= scoring.ITEM_BYTES and 5_400_000 * 224 / parts <= scoring.USER_BYTES


def test_blocks_grow_with_the_ratings(spark, monkeypatch):
    """Ten blocks, unless these would hold too many ratings; then Spark's own tables lie on disk."""
    rows = spark.createDataFrame([(u, i, 3.0) for u in range(20) for i in range(6)], "userId INT, movieId INT, rating FLOAT")
    of = lambda s: als._sized(s, rows)
    assert of(als.AlsSettings()).getNumUserBlocks() == 10 and of(als.AlsSettings()).getIntermediateStorageLevel() == "MEMORY_AND_DISK"
    monkeypatch.setattr(als, "BLOCK_RATINGS", 10)
    large = of(als.AlsSettings())
    assert (large.getNumUserBlocks(), large.getNumItemBlocks(), large.getIntermediateStorageLevel(), large.getFinalStorageLevel()) == (
        12, 12, "DISK_ONLY", "DISK_ONLY")
    assert of(als.AlsSettings(blocks=3)).getNumUserBlocks() == 3
    assert als.fit(rows, als.AlsSettings(rank=2, max_iter=2, dup_policy="none")).userFactors.count() == 20


def test_a_fit_frees_what_it_shuffled_soon():
    assert als.AlsSettings().checkpoint_every <= 2


def test_grid_fits_of_many_ratings_run_one_by_one(spark, monkeypatch):
    rows = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u in range(12) for i in range(8)], "userId INT, movieId INT, rating DOUBLE")
    running, most, real = [], [], als.fit_and_score

    def counted(*a):
        running.append(1)
        most.append(len(running))
        try:
            return real(*a)
        finally:
            running.pop()

    monkeypatch.setattr(als, "fit_and_score", counted)
    monkeypatch.setattr(als, "GRID_RATINGS", 96)
    outcome = als.grid_search(rows, rows, (1, 2), (0.1, 1.0), als.AlsSettings(max_iter=1))
    assert max(most) == 1 and len(most) == 4
    best = min((r.rmse, r.seq) for r in outcome.results.collect())
    assert (outcome.rmse, outcome.settings.rank) == (best[0], (1, 1, 2, 2)[best[1]])
