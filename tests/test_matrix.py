"""The stored matrix against plain aggregation, and that reading it moves no entries."""

import random

import pytest
from pyspark.sql import functions as F

from palate.operators import matrix
from palate.operators import ratings as rt


def some_ratings(spark, crowded=True):
    rng = random.Random(5)
    rows = [(rng.randrange(200), rng.randrange(60), rng.randrange(1, 11) / 2) for _ in range(3000)]
    rows += [(u, 7, 3.0) for u in range(200, 1800)] if crowded else []
    rows += [(None, 1, 2.0), (1, None, 2.0), (1, 2, None)]
    return spark.createDataFrame(rows, "userId INT, movieId INT, rating DOUBLE")


def rows_of(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.fixture(scope="module")
def stored(spark):
    return matrix.store_matrix(some_ratings(spark), hot_share=0.2, hot_rows=0)


def test_layouts_hold_every_entry_once(spark, stored):
    entries = rows_of(rt.resolve_duplicates(some_ratings(spark), "sum").select("userId", "movieId", "rating"))
    for layout in (stored.by_item, stored.by_user):
        assert rows_of(layout.rows().select("userId", "movieId", "rating")) == entries
    assert {r["movieId"] for r in stored.by_item.hot.select("movieId").distinct().collect()} == {7}
    assert stored.by_user.hot.count() == 0


def test_totals_equal_plain_aggregation(spark, stored):
    entries = rt.resolve_duplicates(some_ratings(spark), "sum")
    assert rows_of(matrix.matrix_norms(stored)) == rows_of(rt.item_norms(entries))
    whole = entries.join(rt.item_norms(entries), "movieId").select("movieId", "userId", "rating", "norm", "raters")
    assert rows_of(matrix.entries_with_norms(stored).select(*whole.columns)) == rows_of(whole)
    plain = entries.groupBy("userId").agg(F.count(F.lit(1)), F.avg("rating"), F.max("rating"))
    assert rows_of(matrix.user_profiles(stored)) == rows_of(plain)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_no_exchange_of_the_entries(spark):
    """Three questions, the hot side aside: nothing is shuffled, with joins by sorting too."""
    quiet = matrix.store_matrix(some_ratings(spark, crowded=False))
    kept = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        item, user = quiet.by_item, quiet.by_user
        totals = item.totals(F.sum("rating").alias("total"))[0]
        assert exchanges(totals)[0] == 0
        assert exchanges(item.cold.join(totals, "movieId"))[0] == 0
        assert exchanges(user.totals(F.max("rating").alias("best"))[0])[0] == 0
        wanted = spark.range(50).select(F.col("id").cast("int").alias("userId"))
        number, plan = exchanges(user.cold.join(wanted, "userId", "left_semi"))
        assert number <= 1 and "Bucketed: true" in plan  # the keys asked for go to the buckets
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_opened_again_and_empty(spark, stored, tmp_path):
    spark.sql(f"DROP TABLE {matrix._name(stored.path, 'movieId')}")
    again = matrix.open_matrix(spark, stored.path, stored.buckets)
    assert rows_of(matrix.matrix_norms(again)) == rows_of(matrix.matrix_norms(stored))
    none = matrix.store_matrix(some_ratings(spark).limit(0), path=str(tmp_path / "none"))
    assert matrix.matrix_norms(none).count() == matrix.entries_with_norms(none).count() == 0
