"""Sinks: partitioned tables, models, feedback, exports."""

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.functions.columns import epoch_seconds_now, fixed_score, iso_utc
from palate.operators.als import save_model


def write_neighbors(neighbors: DataFrame, path: str, files: int | None = None) -> None:
    """Replace a neighbour table, range-partitioned by item so that lookups skip files."""
    columns = neighbors.select(
        F.col("movieId").cast("int").alias("movieId"),
        F.col("neighborId").cast("int").alias("neighborId"),
        "similarity",
        "rank",
    )
    keys = ["movieId", "rank"]
    spread = columns.repartitionByRange(files, *keys) if files else columns.repartitionByRange(*keys)
    spread.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_model(model: ALSModel, path: str) -> None:
    """Replace a saved model."""
    save_model(model, path)


def append_feedback(feedback: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append ratings given now, or at ``timestamp`` where the column is there.

    New files are added, never a line to a shared file: any number of writers may append.
    """
    if "timestamp" not in feedback.columns:
        feedback = feedback.withColumn("timestamp", epoch_seconds_now())
    rows = feedback.select("userId", "movieId", "rating", "timestamp")
    _append(rows, path, fmt)


def append_reviews(reviews: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append ``mode, movieId, rating, comment`` stamped with the current UTC time."""
    rows = reviews.select(
        iso_utc().alias("ts_utc"),
        "mode",
        "movieId",
        F.col("rating").cast("double").alias("rating"),
        F.trim("comment").alias("comment"),
    )
    _append(rows, path, fmt)


def _append(rows: DataFrame, path: str, fmt: str) -> None:
    writer = rows.write.mode("append")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_ratings(ratings: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the merged rating table."""
    writer = ratings.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def export_scores(recs: DataFrame, path: str) -> None:
    """``title<TAB>score`` lines with four decimals, best first within each query."""
    keys = [c for c in ("queryId", "userId") if c in recs.columns]
    ordered = recs.repartitionByRange(*keys, "rank").sortWithinPartitions(*keys, "rank")
    lines = ordered.select("title", fixed_score("score").alias("score"))
    lines.write.mode("overwrite").option("sep", "\t").csv(path)


def write_grid(results: DataFrame, path: str) -> None:
    """Grid results as JSON lines."""
    results.write.mode("overwrite").json(path)
