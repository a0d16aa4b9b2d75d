"""The stored matrix: what is asked of it by item and by user."""

from pyspark.sql import functions as F

from palate.operators import matrix
from palate.plans.registry import query, views


def stored(t) -> matrix.StoredMatrix:
    return matrix.store_matrix(t.ratings())


@query("matrix_norms", views("norms") + " SELECT movieId, round(norm, 6) AS norm, raters FROM norms")
def matrix_norms(t):
    return matrix.matrix_norms(stored(t)).withColumn("norm", F.round("norm", 6))


@query(
    "matrix_entries",
    views("entries", "norms")
    + """ SELECT e.userId, e.movieId, e.rating, round(norm, 6) AS norm, raters
    FROM entries e JOIN norms n ON n.movieId = e.movieId""",
)
def matrix_entries(t):
    return matrix.entries_with_norms(stored(t)).withColumn("norm", F.round("norm", 6))


@query(
    "matrix_profiles",
    views("entries")
    + " SELECT userId, count(*) AS n, round(avg(rating), 9) AS mean, max(rating) AS best FROM entries GROUP BY userId",
)
def matrix_profiles(t):
    return matrix.user_profiles(stored(t)).withColumn("mean", F.round("mean", 9))


@query(
    "matrix_histories",
    views("entries", "evts")
    + " SELECT userId, movieId, rating FROM entries WHERE userId IN (SELECT userId FROM evts WHERE eventType = 'signup')",
)
def matrix_histories(t):
    """The entries of the users that signed up, from the layout by user."""
    signed_up = t.events().where(F.col("eventType") == "signup")
    return stored(t).by_user.of(signed_up)
