"""Recommendations from favourite titles by closeness of item factors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.operators.catalog import complete_lists, only_titled
from palate.operators.ranking import top_k_per
from palate.operators.tiles import vector_top_k
from palate.session import settle

#: Favourites of a query up to which lists are made per favourite.
MANY = 200


def recommend_near_items(
    favorites: DataFrame,
    factors: DataFrame,
    k: int = 10,
    items: DataFrame | None = None,
    include_zero: bool = False,
    **blocks,
) -> DataFrame:
    """``queryId, movieId, score, rank``: best cosine to any favourite, favourites excluded.

    ``favorites`` is ``queryId, movieId``; ``items`` limits what may be recommended.  A query none of
    whose favourites has factors gets no list, or with ``include_zero`` every item at score 0: the
    ``k`` smallest ids that are no favourites of it.
    """
    vectors = factors.select(F.col("id").alias("movieId"), "features")
    liked = favorites.select("queryId", "movieId").distinct()
    queries = liked.join(vectors, "movieId").where(F.col("features").isNotNull()).select("queryId", "features")
    pool = vectors if items is None else vectors.join(items.select("movieId"), "movieId", "left_semi")
    best = _near_lists(liked, vectors, pool.select(F.col("movieId").alias("id"), "features"), k, **blocks)
    best = best.withColumnRenamed("id", "movieId")
    if not include_zero:
        return best
    unknown = settle(liked.join(queries.select("queryId").distinct(), "queryId", "left_anti"), "without-factors")
    titles = pool.where(F.col("features").isNotNull()).select("movieId").distinct()
    zeros = complete_lists(best.limit(0), unknown.select("queryId"), titles, unknown, k)
    return best.unionByName(zeros.select(*[F.col(c).cast(best.schema[c].dataType).alias(c) for c in best.columns]))


def _near_lists(liked: DataFrame, vectors: DataFrame, offered: DataFrame, k: int, **blocks) -> DataFrame:
    """``queryId, id, score, rank``: each favourite's nearest items are found once for all who like it.

    An item of a query's list is among the ``k`` nearest of one of its favourites, beside the items that
    the query bars, so each favourite's list is as long as ``k`` and the barred items of its most demanding
    query.  Queries of more than ``MANY`` favourites would make these long; they bring their own vectors.
    """
    liked = settle(liked, "favorites")
    found = liked.join(vectors, "movieId").where(F.col("features").isNotNull())
    sizes = liked.groupBy("queryId").agg(F.count(F.lit(1)).alias("__n"))
    barred = liked.select("queryId", F.col("movieId").alias("id"))
    few = settle(liked.join(sizes.where(F.col("__n") <= MANY), "queryId"), "few-favorites")
    asked = few.groupBy("movieId").agg((F.lit(k) + F.max("__n")).cast("int").alias("keep"))
    asked = asked.join(vectors, "movieId").where(F.col("features").isNotNull())
    near = vector_top_k(asked.withColumnRenamed("movieId", "queryId"), offered, k + MANY, **blocks)
    near = settle(near.withColumnRenamed("queryId", "movieId"), "near-favorites")
    met = few.withColumn("queryId", F.col("queryId").cast("bigint")).join(near, "movieId")
    met = met.where(F.col("rank") <= F.col("__n") + F.lit(k))
    scored = met.groupBy("queryId", "id").agg(F.max("score").alias("score"))
    best = top_k_per(scored.join(barred, ["queryId", "id"], "left_anti"), "queryId", [F.desc("score"), F.asc("id")], k)
    many = sizes.where(F.col("__n") > MANY)
    if many.isEmpty():
        return best
    mine = lambda df: df.join(many.select("queryId"), "queryId", "left_semi")
    # Only items that are offered take places from others.
    own = mine(barred).join(offered.where(F.col("features").isNotNull()).select("id"), "id", "left_semi")
    rest = vector_top_k(mine(found.select("queryId", "features")), offered, k, exclude=own, **blocks)
    return best.unionByName(rest)


def recommend_for_favorites(
    favorites: DataFrame, movies: DataFrame, factors: DataFrame, k: int = 10, **blocks
) -> DataFrame:
    """``queryId, movieId, title, score, rank`` for favourites given as ``queryId, title``.

    Every movie of a matching title counts as a favourite; a query whose titles all fail to
    match gets no rows (``unmatched_titles`` reports them).
    """
    liked = favorites.join(movies.select("title", "movieId"), "title").select("queryId", "movieId")
    best = recommend_near_items(liked, factors, k, items=movies, **blocks)
    return only_titled(best, movies).select("queryId", "movieId", "title", "score", "rank")
