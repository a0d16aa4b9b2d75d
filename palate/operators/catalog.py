"""Titles and histories: lookups, repairs, per-user context."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.functions.columns import genre_array, title_year
from palate.operators.ranking import lookup_for, numbered, top_k_per

UNKNOWN_TITLE = "(unknown title)"


def titles_to_ids(titles: DataFrame, movies: DataFrame, every_match: bool = False) -> DataFrame:
    """``titles`` plus ``movieId``, by exact title; null marks a title nobody knows.

    Titles need not be unique.  By default the smallest id answers; ``every_match`` keeps all.
    """
    wanted = movies.select("title", "movieId").join(titles.select("title"), "title", "left_semi")
    if not every_match:
        wanted = wanted.groupBy("title").agg(F.min("movieId").alias("movieId"))
    return titles.join(wanted, "title", "left")


def unmatched_titles(titles: DataFrame, movies: DataFrame) -> DataFrame:
    """Titles that name no movie; a caller who wants an error tests this for emptiness."""
    return titles.join(movies.select("title"), "title", "left_anti")


def with_titles(rows: DataFrame, movies: DataFrame, size_bound: int | None = None) -> DataFrame:
    """Left join of the title.  Pass ``size_bound`` when ``rows`` is known to be a short list."""
    titles = movies.select("movieId", "title")
    if size_bound is not None:
        return lookup_for(rows, size_bound, titles, "movieId")
    return rows.join(titles, "movieId", "left")


def only_titled(rows: DataFrame, movies: DataFrame) -> DataFrame:
    """Inner join of the title: items missing from the catalogue disappear, ``rank`` is kept."""
    return rows.join(movies.select("movieId", "title"), "movieId")


def fill_titles(rows: DataFrame, fallback: DataFrame) -> DataFrame:
    """Null titles are looked up once more in ``fallback``."""
    second = fallback.select("movieId", F.col("title").alias("__title"))
    filled = rows.join(second, "movieId", "left")
    return filled.withColumn("title", F.coalesce("title", "__title")).drop("__title")


def placeholder_titles(rows: DataFrame, text: str = UNKNOWN_TITLE) -> DataFrame:
    return rows.withColumn("title", F.coalesce("title", F.lit(text)))


def missing_title_check(rows: DataFrame, limit: float = 0.5) -> DataFrame:
    """One row: share of missing titles, and whether it says that model and catalogue differ."""
    ratio = F.avg(F.col("title").isNull().cast("double"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), ratio.alias("missing_ratio")).withColumn(
        "mismatch", F.coalesce(F.col("missing_ratio") > limit, F.lit(False))
    )


def first_titles(movies: DataFrame, n: int) -> DataFrame:
    """The first ``n`` catalogue entries by id."""
    return movies.select("movieId", "title").orderBy("movieId").limit(n)


def explode_genres(movies: DataFrame) -> DataFrame:
    """One row per (movie, genre), with the year its title ends in."""
    return movies.select(
        "movieId",
        title_year("title").alias("year"),
        F.explode(genre_array("genres")).alias("genre"),
    )


def user_history(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """``userId, movieId, rating`` of the users asked for."""
    return ratings.join(users.select("userId").distinct(), "userId", "left_semi").select(
        "userId", "movieId", "rating"
    )


def recent_ratings(
    ratings: DataFrame, movies: DataFrame, n: int = 25, users: DataFrame | None = None
) -> DataFrame:
    """Latest ``n`` ratings per user with titles; titles are joined after the cut."""
    if users is not None:
        ratings = ratings.join(users.select("userId").distinct(), "userId", "left_semi")
    order = [F.desc("timestamp"), F.desc("rating"), F.asc("movieId")]
    latest = top_k_per(ratings, "userId", order, n, rank="recency")
    return with_titles(latest, movies).select(
        "userId", "movieId", "title", "rating", "timestamp", "recency"
    )


def complete_lists(best: DataFrame, queries: DataFrame, catalogue: DataFrame, barred: DataFrame, k: int) -> DataFrame:
    """Pad lists shorter than ``k`` with the smallest ids not listed, at score 0.

    ``best`` is ``queryId, movieId, score`` (a stored table; other columns are dropped), ``queries``
    the ``queryId`` that get a list, ``catalogue`` distinct ``movieId``, ``barred`` distinct
    ``queryId, movieId``; the result is ``queryId, movieId, score, rank``.

    A list of ``h`` items with ``b`` barred ones finds its padding among the first ``k + b``
    catalogue entries that are not in the list, hence among the first ``k + b + h``: each short
    list unfolds that many places of the numbered catalogue and looks their ids up.
    """
    have = best.groupBy("queryId").agg(F.count(F.lit(1)).alias("__have"))
    bars = barred.groupBy("queryId").agg(F.count(F.lit(1)).alias("__barred"))
    reach = F.coalesce("__have", F.lit(0)) + F.coalesce("__barred", F.lit(0)) + F.lit(k)
    short = (
        queries.select("queryId").distinct().join(have, "queryId", "left")
        .where(F.coalesce("__have", F.lit(0)) < k)
        .join(bars, "queryId", "left")
        .select("queryId", reach.cast("int").alias("__reach"))
    )
    places = numbered(catalogue.select("movieId"), [F.asc("movieId")], "__at")
    padding = (
        short.select("queryId", F.explode(F.sequence(F.lit(1), F.col("__reach"))).alias("__at"))
        .join(places, "__at")
        .select("queryId", "movieId")
        .join(barred, ["queryId", "movieId"], "left_anti")
        .join(best, ["queryId", "movieId"], "left_anti")
        .withColumn("score", F.lit(0.0))
    )
    both = best.select("queryId", "movieId", "score").unionByName(padding)
    return top_k_per(both, "queryId", [F.desc("score"), F.asc("movieId")], k)
