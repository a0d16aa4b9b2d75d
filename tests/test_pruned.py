"""Pruned products: the same rows as the whole product, from fewer products."""

import random

import pytest

from palate.operators import pruned
from palate.operators.pruned import pruned_top_k
from palate.operators.tiles import vector_top_k


def vectors(spark, n, name, spread, seed, ids=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.paretovariate(1.5) if spread else 1.0
        rows.append((i if ids is None else ids(i), [size * (0.5 + rng.random()) for _ in range(6)]))
    return spark.createDataFrame([*rows, (10**6, None)], f"{name} bigint, features array<double>")


def rows_of(df):
    return sorted((r["queryId"], r["rank"], r["id"], round(r["score"], 5)) for r in df.collect())


@pytest.mark.parametrize("spread", [True, False])
@pytest.mark.parametrize("k", [1, 7, 40])
def test_same_rows(spark, spread, k):
    queries, items = vectors(spark, 120, "queryId", True, 1), vectors(spark, 900, "id", spread, 2, lambda i: i * 3)
    done = pruned_top_k(queries, items, k, band_rows=30)
    assert rows_of(done.lists) == rows_of(vector_top_k(queries, items, k, metric="dot"))
    assert done.possible == 120 * 900
    if spread:
        assert done.formed < done.possible / 2


def test_ties_zero_vectors_and_negative_parts(spark):
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [-1.0, -2.0])], "queryId int, features array<double>")
    items = spark.createDataFrame([(i, [float(1 + i % 2), float(i % 3)]) for i in range(40)] + [(99, [0.0, 0.0])], "id int, features array<double>")
    for k in (1, 5, 60):
        done = pruned_top_k(queries, items, k, band_rows=4)
        assert rows_of(done.lists) == rows_of(vector_top_k(queries, items, k, metric="dot"))


def test_fewer_items_in_the_first_band_than_asked_for(spark):
    queries, items = vectors(spark, 20, "queryId", True, 3), vectors(spark, 50, "id", True, 4)
    done = pruned_top_k(queries, items, 12, band_rows=5)
    assert rows_of(done.lists) == rows_of(vector_top_k(queries, items, 12, metric="dot"))


def test_empty_sides(spark):
    some, none = vectors(spark, 5, "queryId", True, 5), vectors(spark, 5, "id", True, 6).limit(0)
    assert pruned_top_k(some, none, 3).lists.count() == 0
    assert pruned_top_k(none.withColumnRenamed("id", "queryId"), some.withColumnRenamed("queryId", "id"), 3).lists.count() == 0


def test_bands_share_blocks():
    """Short bands that follow each other lie in one block, a long one in several: few copies of queries, few lists."""
    start, parts, lowest = pruned._blocks([30, 30, 30, 30, 250, 10], 1, 100)
    assert (start[1:], parts[1:], lowest) == ([0, 0, 0, 1, 4], [1, 1, 1, 3, 1], [1, 4, 4, 4, 5])
    start, parts, lowest = pruned._blocks([40] * 32, 0, 10_000)
    assert lowest == [0] and set(start) == {0} and set(parts) == {1}
