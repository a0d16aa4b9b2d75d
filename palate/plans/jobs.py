"""The two recurring jobs, each one Spark application from files to files.

What a job stores on its way is deleted when it ends.
"""

from collections.abc import Iterable
from dataclasses import replace

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import SparkSession

from palate.operators import als
from palate.operators.neighbors import TOP_N, precompute_neighbors
from palate.operators.ratings import hash_split, merge_feedback, reviews_as_ratings
from palate.session import workspace
from palate.sources import readers, writers


def tune(
    spark: SparkSession,
    ratings_path: str,
    model_path: str,
    neighbors_path: str | None = None,
    grid_path: str | None = None,
    ranks: Iterable[int] = als.GRID_RANKS,
    regs: Iterable[float] = als.GRID_REGS,
    base: als.AlsSettings = als.AlsSettings(max_iter=als.GRID_ITERATIONS),
    top_n: int = TOP_N,
    method: str = "auto",
    fmt: str = "csv",
    parallel: int | None = None,
    **options,
) -> als.GridOutcome:
    """Grid search, save the best model, precompute its item neighbours.

    The model of the outcome is the saved one, which rests on no intermediate table.
    """
    with workspace(spark):
        train, val = hash_split(readers.read_ratings(spark, ratings_path, fmt))
        outcome = als.grid_search(train, val, ranks, regs, base, parallel)
        writers.write_model(outcome.model, model_path)
        outcome = replace(outcome, model=ALSModel.load(model_path))
        if grid_path is not None:
            writers.write_grid(outcome.results, grid_path)
        if neighbors_path is not None:
            found = precompute_neighbors(outcome.model.itemFactors, top_n, method, **options)
            writers.write_neighbors(found, neighbors_path)
    return outcome


def nightly_retrain(
    spark: SparkSession,
    ratings_path: str,
    merged_path: str,
    model_path: str,
    feedback_path: str | None = None,
    reviews_path: str | None = None,
    settings: als.AlsSettings = als.AlsSettings(),
    fmt: str = "csv",
) -> float | None:
    """Fold feedback and signed reviews into the ratings, store them, retrain; returns the RMSE."""
    with workspace(spark):
        merged = readers.read_ratings_with_feedback(spark, ratings_path, feedback_path, fmt)
        if reviews_path is not None and readers.path_exists(spark, reviews_path):
            merged = merge_feedback(merged, reviews_as_ratings(readers.read_reviews(spark, reviews_path)))
        writers.write_ratings(merged, merged_path)
        stored = spark.read.schema(merged.schema).parquet(merged_path)
        model, error = als.train_model(stored, settings)
        writers.write_model(model, model_path)
    return error
