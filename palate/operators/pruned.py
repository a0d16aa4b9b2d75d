"""Exact best items by dot product, forming only the products that can matter.

Items are cut into bands by length, the longest first.  Every query is multiplied with the first band,
which gives it ``k`` scores to beat.  No score exceeds the product of the two lengths, so a query needs
only the bands whose longest item, times its own length, can still reach its ``k``-th score.  Queries
that need equally many bands are packed together, and the other tiles are never made.

Defined cases: rows without a vector take no part; vectors without length score 0 like any other; equal
scores go to the smaller id; a query may have one vector only; an empty side gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.functions.vectors import l2_norm
from palate.operators.ranking import SCORE_DIGITS, rounded, top_k_per
from palate.operators.tiles import _SCORES_DDL, LEFT, RIGHT, _tiles, _vector_tile, blocks_for, packed, rows_per_block
from palate.session import settle

#: Items in a band, unless there would be more bands than ``MOST_BANDS``; then bands grow and are cut by id.
BAND_ROWS = 512
MOST_BANDS = 32


@dataclass(frozen=True)
class Pruned:
    """``lists`` is ``queryId, id, score, rank``; ``formed`` of ``possible`` products were formed."""

    lists: DataFrame
    formed: int
    possible: int


def _bands(items: DataFrame, band_rows: int) -> tuple[DataFrame, list[tuple[float, int]]]:
    """Items with their ``band``, and each band's longest length and number of items, first band first."""
    n = items.count()
    wanted = min(MOST_BANDS, ceil(n / band_rows))
    if wanted > 1:
        shares = [1 - i / wanted for i in range(1, wanted)]
        edges = sorted(set(items.agg(F.percentile_approx("length", F.lit(shares), 100 * wanted)).first()[0]), reverse=True)
        band = F.size(F.filter(F.lit(edges), lambda e: F.col("length") < e))
    else:
        band = F.lit(0)
    banded = settle(items.withColumn("band", band.cast("int")), "banded-items")
    sizes = banded.groupBy("band").agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("n")).orderBy("band").collect()
    renumbered = F.create_map(*[F.lit(x) for at, r in enumerate(sizes) for x in (r["band"], at)]) if sizes else None
    if renumbered is not None:  # bands that no item fell into are skipped
        banded = banded.withColumn("band", renumbered[F.col("band")])
    return banded, [(r["longest"], r["n"]) for r in sizes]


def _cut(column: str, groups: list[int], key: str) -> Column:
    """Number of the sub-block of a row in its group, from the group's number of sub-blocks."""
    parts = F.element_at(F.lit(groups), F.col(key) + 1)
    return F.pmod(F.xxhash64(column), parts).cast("int")


def _blocks(sizes: list[int], first: int, rows: int) -> tuple[list[int], list[int], list[int]]:
    """Of each band its first block and the number of its blocks; of each block its first band.

    Bands that follow each other share a block of about ``rows`` items; a larger band is cut into several.
    """
    start, parts, lowest, held = [0] * first, [1] * first, [], rows
    for band, n in enumerate(sizes[first:], first):
        parts.append(max(1, ceil(n / rows)))
        if parts[-1] > 1 or held + n > rows:
            lowest += [band] * parts[-1]
            held = 0
        held = rows if parts[-1] > 1 else held + n
        start.append(len(lowest) - parts[-1])
    return start, parts, lowest


def _scores(queries: DataFrame, depths: list[int], items: DataFrame, sizes: list[int], first: int, width: int) -> DataFrame:
    """``queryId, id, score`` of each query (``depth``) and the bands ``first`` to ``depth``."""
    per_block = lambda n: max(1, ceil(n / blocks_for(queries.sparkSession, n, rows_per_block(width))))
    asked = max(1, per_block(sum(depths)))
    lefts = [max(1, ceil(n / asked)) if n else 0 for n in depths]
    start, parts, lowest = _blocks(sizes, first, per_block(sum(sizes[first:])))
    cut = _cut("queryId", [max(1, n) for n in lefts], "depth")
    left = packed(queries.select("depth", cut.alias("__lc"), "queryId", "features", "keep", F.col("depth").alias("__depth")),
                  ["depth", "__lc"], sum(lefts), "queryId")
    block = F.element_at(F.lit(start), F.col("band") + 1) + _cut("id", parts, "band")
    right = packed(items.select(block.cast("int").alias("__rb"), "id", "features", "band"), ["__rb"], len(lowest), "id")
    # Blocks of queries are numbered along the depths.
    before, deep = [sum(lefts[:d]) for d in range(len(lefts))], [d for d, n in enumerate(lefts) for _ in range(n)]
    at = lambda numbers, place: F.element_at(F.lit(numbers), (place + 1).cast("int"))
    places = lambda numbers: F.sequence(F.lit(0), F.lit(len(numbers) - 1))
    meets = F.explode(F.filter(places(lowest), lambda rb: at(lowest, rb) <= F.col("depth")))
    left = left.select((at(before, F.col("depth")) + F.col("__lc")).alias("__lb"), meets.alias("__rb"), F.lit(LEFT).alias("side"), "piece")
    meets = F.explode(F.filter(places(deep), lambda lb: at(deep, lb) >= at(lowest, F.col("__rb"))))
    right = right.select(meets.alias("__lb"), "__rb", F.lit(RIGHT).alias("side"), "piece")
    pieces, number = left.unionByName(right), F.col("__lb") * len(lowest) + F.col("__rb")
    return _tiles(pieces, number, sum(lefts) * len(lowest), _vector_tile("dot", None), _SCORES_DDL)


def pruned_top_k(queries: DataFrame, items: DataFrame, k: int, band_rows: int = BAND_ROWS) -> Pruned:
    """The ``k`` items of largest dot product per query, as ``tiles.vector_top_k`` gives them.

    ``queries`` is ``queryId, features`` with one vector per query, ``items`` is ``id, features``.
    """
    present = F.col("features").isNotNull()
    asked = queries.where(present).select(F.col("queryId").cast("bigint").alias("queryId"), "features", F.lit(k).alias("keep"))
    asked = settle(asked.withColumn("length", l2_norm("features")), "asked")
    offered = items.where(present).select(F.col("id").cast("bigint").alias("id"), "features")
    width = offered.agg(F.max(F.size("features"))).first()[0]
    offered, bands = _bands(offered.withColumn("length", l2_norm("features")), max(band_rows, 2 * k))
    n_asked, sizes = asked.count(), [n for _, n in bands]
    if not bands or not n_asked:
        none = asked.sparkSession.createDataFrame([], "queryId bigint, id bigint, score double, rank int")
        return Pruned(none, 0, 0)
    start = _scores(asked.withColumn("depth", F.lit(0)), [n_asked], offered.where("band = 0"), sizes[:1], 0, width)
    start = settle(_best(start, k), "first-band")
    # The k-th score of the first band; a query with fewer scores has nothing to beat.
    floor = start.where(F.col("rank") == k).select("queryId", F.col("score").alias("floor"))
    # Scores are compared as they are rounded, and a product may exceed the bound by its rounding errors.
    slack = 10.0**-SCORE_DIGITS + F.lit(1e-9) * F.col("length") * bands[0][0]
    beats = lambda longest: F.col("floor").isNull() | (F.col("length") * longest + slack >= F.col("floor"))
    depth = F.size(F.filter(F.lit([longest for longest, _ in bands[1:]]).cast("array<double>"), beats))
    asked = settle(asked.join(floor, "queryId", "left").withColumn("depth", depth), "asked-depths")
    by_depth = {r["depth"]: r["n"] for r in asked.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).collect()}
    depths = [by_depth.get(d, 0) for d in range(len(bands))]
    formed = n_asked * sizes[0] + sum(n * sum(sizes[1 : d + 1]) for d, n in enumerate(depths))
    found = start.select("queryId", "id", "score")
    if any(depths[1:]):
        further = _scores(asked.where("depth > 0"), [0, *depths[1:]], offered.where("band > 0"), sizes, 1, width)
        found = found.unionByName(further.withColumn("score", rounded(F.col("score"))))
    return Pruned(_best(found, k), formed, n_asked * sum(sizes))


def _best(scores: DataFrame, k: int) -> DataFrame:
    shown = scores.withColumn("score", rounded(F.col("score")))
    return top_k_per(shown, "queryId", [F.desc("score"), F.asc("id")], k)
