"""Entry weights that damp heavy raters: TF-IDF and BM25 with users in the role of terms.

Input and output are ``userId, movieId, rating`` with one row per pair.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.operators.ratings import resolve_duplicates
from palate.session import settle

BM25_K1 = 1.2
BM25_B = 0.75


def _with_user_idf(entries: DataFrame) -> DataFrame:
    """Adds ``idf = ln(number of items / items the user rated)``; 0 for a user who rated all."""
    per_user = entries.groupBy("userId").agg(F.count(F.lit(1)).alias("__df"))
    n_items = entries.agg(F.count_distinct("movieId").alias("n")).scalar()
    idf = per_user.select("userId", F.log(n_items / F.col("__df")).alias("idf"))
    return entries.join(idf, "userId")


def tfidf(entries: DataFrame) -> DataFrame:
    weighted = F.col("rating") * F.col("idf")
    return _with_user_idf(entries).select("userId", "movieId", weighted.alias("rating"))


def bm25(entries: DataFrame, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """``x(k1+1) / (x + k1(1 - b + b·len/avglen)) · idf``; ``len`` is an item's rating total."""
    lengths = entries.groupBy("movieId").agg(F.sum("rating").alias("__len"))
    mean_length = lengths.agg(F.avg("__len").alias("m")).scalar()
    x = F.col("rating")
    pull: Column = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("__len") / mean_length)
    saturated = x * F.lit(k1 + 1.0) / (x + pull)
    return (
        _with_user_idf(entries)
        .join(lengths, "movieId")
        .select("userId", "movieId", (saturated * F.col("idf")).alias("rating"))
    )


WEIGHTINGS = {"none": lambda entries: entries, "tfidf": tfidf, "bm25": bm25}


def weigh(entries: DataFrame, weighting: str = "none") -> DataFrame:
    if weighting not in WEIGHTINGS:
        raise ValueError(f"weighting must be one of {sorted(WEIGHTINGS)}, not {weighting!r}")
    return WEIGHTINGS[weighting](entries)


def rating_entries(ratings: DataFrame, dup_policy: str = "sum", weighting: str = "none") -> DataFrame:
    """The rating matrix as a stored long table ``userId, movieId, rating``, one row per pair.

    Similarity reads it several times, so it is written once instead of being derived again
    from the source for every use.
    """
    entries = settle(resolve_duplicates(ratings, dup_policy), "entries")
    if weighting == "none":
        return entries
    return settle(weigh(entries, weighting), "entries")
