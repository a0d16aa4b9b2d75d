"""Batch and stream readers with declared schemas (inference would cost a second pass)."""

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate import schemas
from palate.functions.columns import lenient_id, trim_headers
from palate.operators.ratings import merge_feedback

FORMATS = ("csv", "parquet", "orc", "json")


def _read(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    reader = spark.read.schema(schema)
    if fmt == "csv":
        # Columns are matched by position against the declared schema; a differing header is
        # an error rather than silently swapped data.
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(path)


def read_ratings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schemas.RATINGS, fmt)


def read_movies(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schemas.MOVIES, fmt)


def read_feedback(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schemas.FEEDBACK, fmt)


def read_reviews(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schemas.REVIEWS, fmt)


def read_neighbors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.NEIGHBORS).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_ratings_with_feedback(
    spark: SparkSession, ratings_path: str, feedback_path: str | None, fmt: str = "csv"
) -> DataFrame:
    """Ratings plus the feedback captured so far; a feedback path not written yet adds nothing."""
    ratings = read_ratings(spark, ratings_path, fmt)
    if feedback_path is None or not path_exists(spark, feedback_path):
        return ratings
    return merge_feedback(ratings, read_feedback(spark, feedback_path, fmt))


def read_lenient_csv(spark: SparkSession, path: str, id_columns: tuple[str, ...]) -> DataFrame:
    """CSV of doubtful quality: padded header names, ids that may not be numbers (become null)."""
    raw = trim_headers(spark.read.option("header", True).csv(path))
    ids = {c: lenient_id(c) for c in id_columns if c in raw.columns}
    return raw.withColumns(ids) if ids else raw


def load_als(path: str) -> ALSModel:
    return ALSModel.load(path)


def load_als_or_none(spark: SparkSession, path: str) -> ALSModel | None:
    """None when nothing is saved at ``path``; a model that is there but broken still raises."""
    return ALSModel.load(path) if path_exists(spark, path) else None


def literal_users(spark: SparkSession, user_ids: list[int]) -> DataFrame:
    return spark.createDataFrame([(int(u),) for u in user_ids], "userId INT")


def empty_recommendations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.RECOMMENDATIONS)


def stream_feedback(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Feedback files as a stream, with ``event_time`` taken from the epoch seconds."""
    reader = spark.readStream.schema(schema or schemas.FEEDBACK)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(path)
    if "timestamp" in stream.columns:
        stream = stream.withColumn("event_time", F.timestamp_seconds("timestamp"))
    return stream
