"""Expected values on the twelve-row sample, computed by hand from the definitions."""

import pytest
from pyspark.sql import functions as F

from palate.operators import catalog, coldstart, popularity
from palate.operators import ratings as rt
from palate.operators.weighting import rating_entries


def pairs(df, key="movieId", value="score", order="rank"):
    return [(r[key], round(r[value], 6)) for r in df.orderBy(order).collect()]


def ids(df):
    return [r["movieId"] for r in df.orderBy("rank").collect()]


def seeds(spark, liked):
    return spark.createDataFrame([(0, m) for m in liked], "queryId INT, movieId INT")


def test_global_mean_and_stats(ratings):
    assert rt.global_mean(ratings).first()["global_mean"] == 3.75
    stats = {r["movieId"]: (r["n"], round(r["mean"], 6)) for r in rt.item_stats(ratings).collect()}
    assert stats == {1: (3, 3.666667), 2: (2, 3.5), 3: (2, 4.0), 4: (1, 4.0), 5: (2, 4.0), 6: (2, 3.5)}


def test_popular_supported(ratings):
    assert ids(popularity.popular_supported(ratings, min_count=1)) == [3, 5, 4, 1, 2, 6]
    assert ids(popularity.popular_supported(ratings, min_count=0)) == [3, 5, 4, 1, 2, 6]
    assert popularity.popular_supported(ratings).isEmpty()


def test_weighted_popularity(ratings):
    best = popularity.weighted_popularity(ratings, m=50)
    assert pairs(best, value="wr") == [
        (3, 3.759615), (5, 3.759615), (4, 3.754902), (1, 3.745283), (2, 3.740385), (6, 3.740385),
    ]
    fixed = popularity.weighted_popularity(ratings, m=50, c=0.0, k=1)
    assert ids(fixed) == [1]


def test_count_times_mean(ratings):
    best = popularity.popular_count_mean(ratings)
    assert pairs(best) == [(1, 11.0), (3, 8.0), (5, 8.0), (2, 7.0), (6, 7.0), (4, 4.0)]


def test_prior_counts_ratings_of_unnamed_items(spark, ratings):
    odd = ratings.unionByName(
        spark.createDataFrame([(9, None, 1.0)], "userId INT, movieId INT, rating DOUBLE")
    )
    mean = rt.global_mean(odd).first()["global_mean"]
    assert mean == pytest.approx((3.75 * 12 + 1) / 13)
    assert popularity.weighted_popularity(odd).count() == 6


@pytest.mark.parametrize(
    "liked, expected",
    [
        ([1], [(3, 0.948683), (6, 0.477028), (2, 0.447214), (4, 0.298142), (5, 0.153393)]),
        ([1, 2], [(3, 1.372947), (6, 0.957028), (5, 0.839387), (4, 0.298142)]),
        ([1, 1], [(3, 1.897367), (6, 0.954056), (2, 0.894427), (4, 0.596285), (5, 0.306786)]),
        ([1, 999], [(3, 0.948683), (6, 0.477028), (2, 0.447214), (4, 0.298142), (5, 0.153393)]),
        ([4], [(5, 0.514496), (1, 0.298142)]),
        ([999], []),
        ([], []),
    ],
)
def test_cold_start(spark, ratings, liked, expected):
    got = coldstart.recommend_for_seeds(ratings, seeds(spark, liked))
    assert [m for m, _ in pairs(got)] == [m for m, _ in expected]
    assert [s for _, s in pairs(got)] == pytest.approx([s for _, s in expected], abs=2e-6)


def test_cold_start_zeros_and_exclusions(spark, ratings):
    with_zero = coldstart.recommend_for_seeds(ratings, seeds(spark, [4]), include_zero=True)
    assert pairs(with_zero) == [(5, 0.514496), (1, 0.298142), (2, 0.0), (3, 0.0), (6, 0.0)]
    barred = seeds(spark, [5, 2])
    rest = coldstart.recommend_for_seeds(
        ratings, seeds(spark, [4]), k=2, exclude=barred, include_zero=True
    )
    assert pairs(rest) == [(1, 0.298142), (3, 0.0)]


def test_shrunk_cold_start(spark, ratings):
    got = coldstart.recommend_for_seeds(ratings, seeds(spark, [1]), shrink=100)
    assert pairs(got) == [(3, 0.018602), (6, 0.004723), (2, 0.004428), (4, 0.002952), (5, 0.001519)]


def test_explanation_names_the_strongest_seed(spark, ratings):
    entries = rating_entries(ratings)
    asked = seeds(spark, [1, 2])
    recs = coldstart.recommend_from_entries(entries, asked)
    reasons = {r["movieId"]: r["seedId"] for r in coldstart.explain(entries, asked, recs).collect()}
    assert reasons == {3: 1, 6: 2, 5: 2, 4: 1}


@pytest.mark.parametrize(
    "policy, expected",
    [("sum", {1: 9.0, 15: 4.0, 4: 4.5}), ("latest", {1: 1.0, 15: 4.0, 4: 4.5}), ("avg", {1: 2.25, 15: 4.0, 4: 4.5})],
)
def test_duplicate_policies(feedback, policy, expected):
    assert {r["userId"]: r["rating"] for r in rt.resolve_duplicates(feedback, policy).collect()} == expected


def test_unknown_policy_is_refused(feedback):
    with pytest.raises(ValueError, match="dup_policy"):
        rt.resolve_duplicates(feedback, "first")


def test_titles(spark, movies):
    asked = spark.createDataFrame([("Heat (1995)",), ("heat (1995)",)], "title STRING")
    found = {r["title"]: r["movieId"] for r in catalog.titles_to_ids(asked, movies).collect()}
    assert found == {"Heat (1995)": 6, "heat (1995)": None}
    assert [r["title"] for r in catalog.unmatched_titles(asked, movies).collect()] == ["heat (1995)"]
    doubled = movies.unionByName(movies.withColumn("movieId", F.col("movieId") + 100))
    assert catalog.titles_to_ids(asked, doubled).where("movieId = 6").count() == 1
    assert catalog.titles_to_ids(asked, doubled, every_match=True).where("movieId is not null").count() == 2


def test_genres_and_years(movies):
    rows = catalog.explode_genres(movies).collect()
    assert {r["year"] for r in rows} == {1995}
    assert sum(r["genre"] == "Comedy" for r in rows) == 4


def test_popular_by_genre(ratings, movies):
    best = popularity.popular_by_genre(ratings, movies, k=1).collect()
    assert {r["genre"]: r["movieId"] for r in best} == {
        "Adventure": 1, "Animation": 1, "Children": 1, "Comedy": 3, "Fantasy": 1, "Romance": 3,
        "Drama": 4, "Action": 6, "Crime": 6, "Thriller": 6,
    }


def test_missing_titles(ratings, movies):
    known = movies.where("movieId > 4")
    rows = catalog.with_titles(ratings.select("movieId"), known)
    check = catalog.missing_title_check(rows).first()
    assert (check["n_rows"], check["mismatch"]) == (12, True)
    assert catalog.missing_title_check(catalog.fill_titles(rows, movies)).first()["missing_ratio"] == 0


def test_exact_percentile_equals_the_aggregate(spark):
    import random

    r = random.Random(2)
    for n, share in ((1, 0.95), (2, 0.5), (37, 0.95), (1000, 0.8), (1001, 0.333)):
        df = spark.createDataFrame([(int(r.expovariate(0.2)),) for _ in range(n)] + [(None,)], "n LONG")
        want = df.agg(F.percentile("n", F.lit(share))).first()[0]
        assert popularity.exact_percentile(df, "n", share).first()[0] == pytest.approx(want, abs=1e-9)
    assert popularity.exact_percentile(spark.createDataFrame([], "n LONG"), "n", 0.5).first()[0] is None


def test_favorites_without_factors_get_zero_lists(spark):
    from palate.operators.favorites import recommend_near_items

    factors = spark.createDataFrame([(i, [float(i), 1.0] if i != 3 else None) for i in range(1, 7)], "id INT, features ARRAY<DOUBLE>")
    asked = spark.createDataFrame([(1, 2), (1, 99), (2, 99), (3, 1), (4, 3), (4, 2)], "queryId INT, movieId INT")
    only_three = spark.createDataFrame([(5, 3), (5, 1000)], "queryId INT, movieId INT")
    got = {}
    for row in recommend_near_items(asked.unionByName(only_three), factors, 4, include_zero=True).orderBy("queryId", "rank").collect():
        got.setdefault(row.queryId, []).append((row.movieId, row.score))
    assert got[2] == got[5] == [(1, 0.0), (2, 0.0), (4, 0.0), (5, 0.0)]
    plain = recommend_near_items(asked.unionByName(only_three), factors, 4).collect()
    assert {x.queryId for x in plain} == {1, 3, 4}
    assert sorted((x.queryId, x.movieId) for x in plain) == sorted((q, i) for q in (1, 3, 4) for i, _ in got[q])
