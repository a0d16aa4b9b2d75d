"""The rating table: cleaning, duplicate policies, merging, splitting, per-item facts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("userId", "movieId")


def drop_incomplete(ratings: DataFrame) -> DataFrame:
    """Rows without a user, an item or a rating take no part in any model or ranking."""
    return ratings.na.drop(subset=[*KEYS, "rating"])


def resolve_duplicates(ratings: DataFrame, policy: str = "sum", ts: str = "timestamp") -> DataFrame:
    """One row per (user, item).

    ``sum`` adds repeated ratings, ``avg`` averages them and ``latest`` keeps the newest (the
    higher rating on equal times).  All three are partial aggregates, so one pair that owns a
    third of the table is folded before the shuffle.
    """
    clean = drop_incomplete(ratings)
    value = F.col("rating").cast("double")
    policies = {
        "sum": lambda: F.sum(value),
        "avg": lambda: F.avg(value),
        "latest": lambda: F.max_by(value, F.struct(F.col(ts), value)),
    }
    if policy not in policies:
        raise ValueError(f"dup_policy must be one of {sorted(policies)}, not {policy!r}")
    return clean.groupBy(*KEYS).agg(policies[policy]().alias("rating"))


def merge_feedback(base: DataFrame, *feedback: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns one side lacks become null."""
    merged = base
    for extra in feedback:
        merged = merged.unionByName(extra, allowMissingColumns=True)
    return merged


def reviews_as_ratings(reviews: DataFrame) -> DataFrame:
    """Reviews tagged ``user:<id>`` in the rating schema; mode reviews name no user and drop out."""
    from palate.functions.columns import iso_epoch, tag_user

    return reviews.select(
        tag_user("mode").alias("userId"),
        F.col("movieId"),
        F.col("rating").cast("float").alias("rating"),
        iso_epoch("ts_utc").alias("timestamp"),
    ).where(F.col("userId").isNotNull())


def hash_bucket() -> Column:
    """Stable bucket 0…99 of a (user, item) pair, independent of file layout, from its MD5 digest."""
    digest = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in KEYS]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def hash_split(ratings: DataFrame, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Reproducible hold-out: the same pair lands on the same side on every cluster and run."""
    in_train = hash_bucket() < train_percent
    return ratings.where(in_train), ratings.where(~in_train)


def random_split(
    ratings: DataFrame, val_ratio: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Random hold-out; seeded, but the outcome depends on how the input is partitioned."""
    train, val = ratings.randomSplit([1 - val_ratio, val_ratio], seed=seed)
    return train, val


def item_stats(ratings: DataFrame) -> DataFrame:
    """``movieId, n, total, mean`` over complete item/rating rows."""
    value = F.col("rating").cast("double")
    return (
        ratings.na.drop(subset=["movieId", "rating"])
        .groupBy("movieId")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    )


def global_mean(ratings: DataFrame) -> DataFrame:
    """One row: the mean of all non-null ratings, items without an id included."""
    return ratings.agg(F.avg(F.col("rating").cast("double")).alias("global_mean"))


def item_norms(entries: DataFrame, value: str = "rating") -> DataFrame:
    """``movieId, norm, raters``: L2 length of each item's rating vector.

    ``entries`` must hold one row per (user, item).
    """
    x = F.col(value).cast("double")
    return entries.groupBy("movieId").agg(
        F.sqrt(F.sum(x * x)).alias("norm"), F.count(F.lit(1)).alias("raters")
    )


def with_norms(entries: DataFrame) -> DataFrame:
    """``userId, movieId, rating, norm``: each entry with the length of its item's rating vector."""
    norms = item_norms(entries).select("movieId", "norm")
    return entries.join(norms, "movieId").select("userId", "movieId", F.col("rating").cast("double").alias("rating"), "norm")


def with_squares(entries: DataFrame) -> DataFrame:
    """``userId, movieId, rating, square``: each entry with the squared length of its item's rating vector."""
    x = F.col("rating").cast("double")
    squares = entries.groupBy("movieId").agg(F.sum(x * x).alias("square"))
    return entries.join(squares, "movieId").select("userId", "movieId", x.alias("rating"), "square")


def known_users(ratings: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct users in id order."""
    users = ratings.select("userId").na.drop().distinct().orderBy("userId")
    return users if limit is None else users.limit(limit)
