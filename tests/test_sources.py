"""Readers and sinks: round trips, dirty input, appends."""

import glob

import pytest
from fixtures import FEEDBACK, MOVIES, RATINGS
from pyspark.sql import functions as F

from palate import schemas
from palate.functions import columns as c
from palate.functions import vectors as v
from palate.operators import ratings as rt
from palate.operators.catalog import first_titles, recent_ratings, user_history
from palate.plans.jobs import nightly_retrain, tune
from palate.session import workspace
from palate.operators.als import AlsSettings
from palate.sources import readers, writers


def text(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def ratings_csv(tmp_path):
    rows = [f"{u},{m},{r},{964982000 + i}" for i, (u, m, r) in enumerate(RATINGS)]
    return text(tmp_path / "ratings.csv", ["userId,movieId,rating,timestamp", *rows])


def test_ratings_csv_is_typed(spark, ratings_csv):
    df = readers.read_ratings(spark, ratings_csv)
    assert df.dtypes == [("userId", "int"), ("movieId", "int"), ("rating", "float"), ("timestamp", "bigint")]
    assert df.count() == 12


def test_swapped_header_is_an_error(spark, tmp_path):
    path = text(tmp_path / "odd.csv", ["movieId,userId,rating,timestamp", "1,2,3.0,4"])
    with pytest.raises(Exception):
        readers.read_ratings(spark, path).collect()


def test_movies_csv_with_quotes(spark, tmp_path):
    lines = ["movieId,title,genres", '11,"American President, The (1995)",Comedy|Drama', "12,Plain,"]
    rows = readers.read_movies(spark, text(tmp_path / "m.csv", lines)).collect()
    assert rows[0]["title"] == "American President, The (1995)"
    assert rows[1]["genres"] is None


def test_feedback_joins_the_ratings_when_it_exists(spark, ratings_csv, tmp_path, feedback):
    path = str(tmp_path / "feedback")
    assert readers.read_ratings_with_feedback(spark, ratings_csv, path).count() == 12
    writers.append_feedback(feedback, path)
    both = readers.read_ratings_with_feedback(spark, ratings_csv, path)
    assert both.count() == 18
    writers.append_feedback(feedback.drop("timestamp"), path)
    assert readers.read_feedback(spark, path).where("timestamp is null").isEmpty()
    assert readers.read_ratings_with_feedback(spark, ratings_csv, path).count() == 24


def test_merge_fills_missing_columns(ratings, feedback):
    merged = rt.merge_feedback(ratings, feedback)
    assert merged.where("timestamp is null").count() == 12


def test_lenient_csv(spark, tmp_path):
    lines = [" userId ,movieId , rating", "1,2,3.0", "abc,3.0,7.0", "4.5,x,", " 7 ,8,3.3"]
    df = readers.read_lenient_csv(spark, text(tmp_path / "dirty.csv", lines), ("userId", "movieId"))
    assert df.columns == ["userId", "movieId", "rating"]
    assert [(r["userId"], r["movieId"]) for r in df.collect()] == [(1, 2), (None, 3), (None, None), (7, 8)]
    valid = [r["ok"] for r in df.select(c.on_rating_scale(F.col("rating").try_cast("double")).alias("ok")).collect()]
    assert valid == [True, False, False, False]


def test_reviews_round_trip(spark, tmp_path):
    given = spark.createDataFrame(
        [("user:1", 5, 3.5, "  good, really \"good\" "), ("mode:cold-start", 6, 1.0, "")],
        "mode STRING, movieId INT, rating DOUBLE, comment STRING",
    )
    path = str(tmp_path / "reviews")
    writers.append_reviews(given, path)
    rows = {r["mode"]: r for r in readers.read_reviews(spark, path).collect()}
    assert rows["user:1"]["comment"] == 'good, really "good"'
    assert rows["user:1"]["ts_utc"].endswith("Z")
    as_ratings = rt.reviews_as_ratings(readers.read_reviews(spark, path)).collect()
    assert [(r["userId"], r["movieId"], r["rating"]) for r in as_ratings] == [(1, 5, 3.5)]
    assert as_ratings[0]["timestamp"] > 1_700_000_000


def test_iso_times_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.range(1).select(
                c.iso_epoch(F.lit("2025-09-25T07:45:38Z")).alias("e"),
                c.iso_utc(F.timestamp_seconds(F.lit(1758786338))).alias("t"),
                c.wall_clock_epoch(F.lit("2025-09-25 07:45:38").cast("timestamp_ntz")).alias("w"),
                c.iso_epoch(F.lit("soon")).alias("bad"),
            ).first()
            assert (row["e"], row["t"], row["w"], row["bad"]) == (1758786338, "2025-09-25T07:45:38Z", 1758786338, None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tags(spark):
    df = spark.createDataFrame([("user:12",), ("mode:weighted_pop",), ("user:x",), (None,)], "mode STRING")
    rows = df.select(c.tag_user("mode").alias("u"), c.tag_mode("mode").alias("m")).collect()
    assert [(r["u"], r["m"]) for r in rows] == [(12, None), (None, "weighted_pop"), (None, None), (None, None)]


def test_vector_functions(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "a ARRAY<FLOAT>, b ARRAY<FLOAT>")
    got = [r["s"] for r in df.select(v.cosine("a", "b").alias("s")).collect()]
    assert got == [pytest.approx(0.96), 0.0, None]
    unit = v.with_unit_vector(df.where("a is not null"), "a", "n").select("n").collect()
    assert list(unit[0]["n"]) == pytest.approx([0.6, 0.8])
    assert list(unit[1]["n"]) == [0.0, 0.0]
    assert v.radius_for_cosine(0.6) == pytest.approx(0.894427, abs=1e-6)


def test_neighbor_table_round_trip(spark, tmp_path):
    sims = spark.createDataFrame(
        [(i, j, 1.0 / (1 + j), j + 1) for i in range(50) for j in range(5)],
        "movieId BIGINT, neighborId BIGINT, similarity DOUBLE, rank INT",
    )
    path = str(tmp_path / "sims")
    writers.write_neighbors(sims, path, files=4)
    writers.write_neighbors(sims, path, files=4)
    back = readers.read_neighbors(spark, path)
    assert back.count() == 250
    assert back.schema.fieldNames() == schemas.NEIGHBORS.fieldNames()
    assert len(list((tmp_path / "sims").glob("*.parquet"))) == 4


def test_score_lines(spark, tmp_path):
    recs = spark.createDataFrame(
        [(1, "Heat (1995)", 0.94868, 1), (1, "Jumanji (1995)", 0.5, 2)],
        "queryId INT, title STRING, score DOUBLE, rank INT",
    )
    writers.export_scores(recs, str(tmp_path / "out"))
    lines = [line for f in (tmp_path / "out").glob("*.csv") for line in f.read_text().splitlines()]
    assert sorted(lines) == ["Heat (1995)\t0.9487", "Jumanji (1995)\t0.5000"]


def test_histories(spark, ratings, movies):
    timed = ratings.withColumn("timestamp", F.col("movieId").cast("bigint"))
    users = spark.createDataFrame([(1,), (77,)], "userId INT")
    recent = recent_ratings(timed, movies, n=2, users=users).orderBy("recency").collect()
    assert [(r["movieId"], r["title"]) for r in recent] == [(6, "Heat (1995)"), (3, "Grumpier Old Men (1995)")]
    assert user_history(ratings, users).count() == 3
    assert [r["movieId"] for r in first_titles(movies, 2).collect()] == [1, 2]


def test_literals(spark):
    assert readers.literal_users(spark, [3, 4]).count() == 2
    assert readers.empty_recommendations(spark).isEmpty()


def test_random_split_covers_everything(ratings):
    train, val = rt.random_split(ratings)
    assert train.count() + val.count() == 12


def test_hash_split_is_disjoint_and_stable(ratings):
    train, val = rt.hash_split(ratings)
    again, _ = rt.hash_split(ratings.repartition(5))
    assert train.count() + val.count() == 12
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, again.collect()))


def test_tune_job_writes_model_grid_and_neighbors(spark, ratings_csv, tmp_path):
    with workspace(spark) as owned:
        out = tune_small(spark, ratings_csv, tmp_path)
        left = glob.glob(f"{owned.removeprefix('file:')}/**/*.parquet", recursive=True)
    assert left == []  # the job deleted what it stored on its way
    assert not out.model.itemFactors.isEmpty()
    assert out.settings.rank == 2
    assert readers.read_neighbors(spark, str(tmp_path / "sims")).count() > 0
    assert readers.load_als_or_none(spark, str(tmp_path / "model")) is not None


def tune_small(spark, ratings_csv, tmp_path):
    return tune(
        spark, ratings_csv, str(tmp_path / "model"), str(tmp_path / "sims"), str(tmp_path / "grid"),
        ranks=(2,), regs=(0.1,), base=AlsSettings(max_iter=2), top_n=3,
    )


def test_nightly_job_merges_feedback_and_trains(spark, ratings_csv, tmp_path, feedback):
    fb, reviews = str(tmp_path / "fb"), str(tmp_path / "reviews")
    writers.append_feedback(feedback, fb)
    given = spark.createDataFrame([("user:1", 5, 3.5, "")], "mode STRING, movieId INT, rating DOUBLE, comment STRING")
    writers.append_reviews(given, reviews)
    merged = str(tmp_path / "merged")
    error = nightly_retrain(
        spark, ratings_csv, merged, str(tmp_path / "model"), fb, reviews, AlsSettings(rank=2, max_iter=2)
    )
    assert spark.read.parquet(merged).count() == 12 + len(FEEDBACK) + 1
    assert error is None or error >= 0
    assert len(MOVIES) == 6
