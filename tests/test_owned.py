"""Sums that stay with the task that owns their query: no pair of items is shuffled or stored."""

import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from palate.operators import fallback, neighbors, products
from palate.session import workspace


def purposes(folder):
    return {p.name.rsplit("-", 1)[0] for p in Path(folder.removeprefix("file:")).iterdir()}


@pytest.mark.parametrize("listed,owned,sent", [(10_000, 64_000_000, 1_000_000), (10_000, 64_000_000, 0), (4, 150, 0), (4, 150, 1_000_000)])
def test_best_sums_by_owner_equal_all_sums(spark, monkeypatch, listed, owned, sent):
    rnd = random.Random(3)
    monkeypatch.setattr(products, "SENT_ROWS", 0)
    for name, value in (("LISTED", listed), ("OWNED", owned), ("SENT_LISTED", sent)):
        monkeypatch.setattr(products, name, value)
    left = [(q, i, float(rnd.randint(1, 5))) for q in range(20) for i in range(30) if rnd.random() < 0.1 + 0.03 * q]
    right = [(i, j, rnd.randint(1, 9) / 4) for i in range(30) for j in range(25) if rnd.random() < 0.3]
    barred = {(q, j) for q in range(20) for j in range(25) if rnd.random() < 0.2}
    sums = defaultdict(float)
    for q, i, x in left:
        for i2, j, y in right:
            if i == i2 and (q, j) not in barred:
                sums[q, j] += x * y
    want = set()
    for q in range(20):
        best = sorted((-v, j) for (q2, j), v in sums.items() if q2 == q)[:4]
        want |= {(q, j, -v, n + 1) for n, (v, j) in enumerate(best)}
    with workspace(spark) as folder:
        got = products.product_top_k(
            spark.createDataFrame(left, "queryId INT, inner INT, x DOUBLE"),
            spark.createDataFrame(right, "inner INT, id BIGINT, y DOUBLE"),
            4, spark.createDataFrame(sorted(barred), "queryId INT, id BIGINT"), cell=products.CELL if owned > 1000 else 20,
        )
        assert {tuple(r) for r in got.select("queryId", "id", "score", "rank").collect()} == want
        if owned > 1000:
            assert "scored" not in purposes(folder)


def test_neighbours_and_histories_store_no_pairs(spark):
    rnd = random.Random(5)
    rows = [(u, i, float(rnd.randint(1, 10)) / 2) for u in range(60) for i in range(40) if rnd.random() < 0.2]
    entries = spark.createDataFrame(rows, "userId INT, movieId INT, rating DOUBLE")
    with workspace(spark) as folder:
        near = neighbors.entry_neighbors(entries, 5, shrink=10.0)
        got = {(r.movieId, r.rank): (r.neighborId, r.similarity) for r in near.collect()}
        assert not purposes(folder) & {"scored", "bounds"}
        by_item = defaultdict(dict)
        for u, i, x in rows:
            by_item[i][u] = x
        length = {i: sum(x * x for x in v.values()) ** 0.5 for i, v in by_item.items()}
        for i, mine in by_item.items():
            found = []
            for j, theirs in by_item.items():
                both = mine.keys() & theirs.keys()
                if i != j and both:
                    cos = sum(mine[u] * theirs[u] for u in both) / (length[i] * length[j])
                    found.append((-round(cos * len(both) / (len(both) + 10.0), 6), j))
            for n, (v, j) in enumerate(sorted(found)[:5]):
                assert got[i, n + 1][0] == j and abs(got[i, n + 1][1] + v) < 2e-6
        table, scores = near.localCheckpoint(), defaultdict(float)
        for u, i, x in rows:
            for n in range(1, 6):
                if (i, n) in got:
                    scores[u, got[i, n][0]] += x * got[i, n][1]
        history = {(r.userId, r.movieId): r.score for r in fallback.score_by_history(entries, table).collect()}
        assert history.keys() == scores.keys() and all(abs(v - scores[k]) < 1e-8 for k, v in history.items())


@pytest.mark.parametrize(
    "values, kind, width",
    [
        ([-3, 4, None, 250], "bigint", 1),
        ([10**9, 10**9 + 70_000], "int", 3),
        ([-(2**40), 2**31 - 2**40], "bigint", 4),
        ([0, 2**40], "bigint", None),
        ([0.5, 5.0, None, 3.5], "double", 1),
        ([0.25, 1000.75], "double", 2),
        ([0.123456, -0.999999, 1.0, 0.3], "double", 3),
        ([0.1234567, 1.0], "double", None),
        ([float("nan"), 1.0], "double", None),
        ([float("inf"), 1.0], "double", None),
        ([None], "double", None),
    ],
)
def test_lists_hold_numbers_in_few_bytes(spark, values, kind, width):
    """Every value comes back as it was; numbers that do not fit are held as they are."""
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    how = products.packings(df, ["c"])["c"]
    assert (sum({"tinyint": 1, "smallint": 2}[p] for p in how.parts) or None) == width
    small = df.select("c", *how.pack(F.col("c")))
    back = small.select("c", how.unpack([F.col(x) for x in how.columns]).alias("back"))
    assert back.schema["back"].dataType == df.schema["c"].dataType
    assert back.where(~F.col("c").eqNullSafe(F.col("back"))).isEmpty()


def test_entries_of_all_digits_bring_no_lengths(spark):
    """Weighted entries travel over their item's length: one number of eight bytes, the same neighbours."""
    rnd = random.Random(8)
    rows = [(u, i, rnd.choice([0.0, rnd.random()])) for u in range(40) for i in range(30) if rnd.random() < 0.3]
    rows += [(u, 99, 0.0) for u in range(5)]  # an item without length
    entries = spark.createDataFrame(rows, "userId INT, movieId INT, rating DOUBLE")
    got = {(r.movieId, r.neighborId): r.similarity for r in neighbors.entry_neighbors(entries, 100).collect()}
    by_item = defaultdict(dict)
    for u, i, x in rows:
        by_item[i][u] = x
    length = {i: sum(x * x for x in v.values()) ** 0.5 for i, v in by_item.items()}
    want = {}
    for i in by_item:
        for j in by_item:
            both = by_item[i].keys() & by_item[j].keys()
            if i != j and both:
                over = length[i] * length[j]
                want[i, j] = sum(by_item[i][u] * by_item[j][u] for u in both) / over if over else 0.0
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-6 for k, v in want.items())


def test_owned_sums_are_few_enough_not_to_spill():
    assert products.PER_OWNER <= 1_000_000
