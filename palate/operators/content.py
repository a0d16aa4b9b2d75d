"""Content likeness from genres, alone or mixed with factor likeness."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.functions.columns import ColumnLike, as_col, genre_array
from palate.operators.tiles import vector_top_k


def jaccard(a: ColumnLike, b: ColumnLike) -> Column:
    """Shared over all distinct elements; 0 for two empty arrays."""
    left, right = as_col(a), as_col(b)
    either = F.size(F.array_union(left, right))
    return F.when(either == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(left, right)) / either
    )


def item_profiles(factors: DataFrame, movies: DataFrame) -> DataFrame:
    """``id, features, tags`` of every movie.

    A movie without factors (nobody rated it yet) gets a zero vector: its cosine is 0 and its
    genres alone place it.
    """
    width = factors.agg(F.max(F.size("features")).alias("w")).scalar()
    vectors = factors.select(F.col("id").alias("movieId"), F.col("features").cast("array<double>").alias("f"))
    profiles = movies.select("movieId", F.array_distinct(genre_array("genres")).alias("tags"))
    return profiles.join(vectors, "movieId", "left").select(
        F.col("movieId").alias("id"),
        F.coalesce("f", F.array_repeat(F.lit(0.0), width)).alias("features"),
        "tags",
    )


def hybrid_neighbors(
    profiles: DataFrame, k: int = 10, factor_weight: float = 0.7, of: DataFrame | None = None, **blocks
) -> DataFrame:
    """``movieId, neighborId, score, rank`` by ``w·cosine(factors) + (1-w)·jaccard(genres)``.

    ``of`` (``movieId``) limits the items neighbours are looked up for.
    """
    asked = profiles
    if of is not None:
        asked = profiles.join(of.select(F.col("movieId").alias("id")), "id", "left_semi")
    best = vector_top_k(
        asked.select(F.col("id").alias("queryId"), "features", "tags"),
        profiles,
        k,
        exclude=asked.select(F.col("id").alias("queryId"), "id"),
        tag_weight=1.0 - factor_weight,
        **blocks,
    )
    return best.select(
        F.col("queryId").alias("movieId"), F.col("id").alias("neighborId"), "score", "rank"
    )
