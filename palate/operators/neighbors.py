"""Item neighbour tables: ``movieId, neighborId, similarity, rank``."""

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.functions.vectors import radius_for_cosine, with_unit_vector
from palate.operators.ranking import SCORE_DIGITS, rounded, top_k_of_many, top_k_per
from palate.operators.products import Packed, _counts, _unowned, cosine, owned_sums, packings, product
from palate.operators.ratings import with_squares
from palate.operators.tiles import block_count, rows_per_block, vector_top_k
from palate.operators.weighting import rating_entries
from palate.session import parallelism, settle

TOP_N = 30
BUCKET_LENGTH = 1.2
HASH_TABLES = 3
COS_THRESHOLD = 0.60

#: Vectors in a part of a bucket, and pairs that a tile holds before it keeps each item's best.
BUCKET_ROWS = 32_768
HELD_PAIRS = 2_000_000

ORDER = (F.desc, "similarity"), (F.asc, "neighborId")


def _ranked(pairs: DataFrame, top_n: int) -> DataFrame:
    order = [direction(name) for direction, name in ORDER]
    best = top_k_per(pairs, "movieId", order, top_n)
    return best.select("movieId", "neighborId", "similarity", "rank")


def rating_neighbors(
    ratings: DataFrame,
    top_n: int = TOP_N,
    dup_policy: str = "sum",
    shrink: float | None = None,
    weighting: str = "none",
) -> DataFrame:
    """Best ``top_n`` neighbours of every item by cosine of rating vectors."""
    return entry_neighbors(rating_entries(ratings, dup_policy, weighting), top_n, shrink)


def entry_neighbors(entries: DataFrame, top_n: int, shrink: float | None = None) -> DataFrame:
    """:func:`rating_neighbors` over entries that are already unique and weighted.

    Everything that shares a user with an item is summed by the task that owns the item, which keeps
    the item's best.  Partners bring the square of their length, which packs better than the length.
    An item of very many products meets its partners pair by pair (:func:`products.product`).
    """
    squared = settle(with_squares(entries), "squared-entries")
    left = squared.select(
        F.col("movieId").alias("queryId"), F.col("userId").alias("inner"), F.col("rating").alias("x"), F.col("square").alias("own")
    )
    right = squared.select(F.col("userId").alias("inner"), F.col("movieId").alias("id"), F.col("rating").alias("y"), "square")
    counts = _counts(left, right)
    unowned = _unowned(left, counts)
    owned = left if unowned is None else left.join(unowned, "queryId", "left_anti")
    lengths = (F.sqrt("own") * F.sqrt("square")).alias("lengths")
    offered, packing = right, packings(right, ["id", "y", "square"])
    if not packing["y"].parts:  # numbers of all digits travel over the partner's length, in the place of both
        over = F.when(F.col("square") == 0, F.lit(0.0)).otherwise(F.col("y") / F.sqrt("square"))
        offered, lengths = right.select("inner", "id", over.alias("y")), F.sqrt("own").alias("lengths")
        packing = packing | {"y": Packed("y", "double")}
    sums = owned_sums(owned, offered, counts, packing=packing).where(F.col("queryId") != F.col("id"))
    sums = sums.select("queryId", "id", "score", "overlap", lengths)
    value = cosine("score", shrink).alias("similarity")
    best = _ranked(sums.select(F.col("queryId").alias("movieId"), F.col("id").alias("neighborId"), rounded(value).alias("similarity")), top_n)
    if unowned is None:
        return best
    normed = lambda df, name: df.withColumn("norm", F.sqrt(name)).drop(name)
    pairs = product(
        normed(left.join(unowned, "queryId", "left_semi"), "own"), normed(right, "square"), lengths=True
    ).where(F.col("queryId") != F.col("id"))
    scored = pairs.select(F.col("queryId").alias("movieId"), F.col("id").alias("neighborId"), value)
    rest = top_k_of_many(scored, "movieId", "similarity", "neighborId", top_n)
    return best.unionByName(rest.select("movieId", "neighborId", "similarity", "rank"))


def factor_neighbors(factors: DataFrame, top_n: int = TOP_N, **blocks) -> DataFrame:
    """Exact best ``top_n`` neighbours of every item by cosine of factors (``id, features``)."""
    queries = factors.select(F.col("id").alias("queryId"), "features")
    itself = factors.select(F.col("id").alias("queryId"), "id")
    best = vector_top_k(queries, factors, top_n, exclude=itself, **blocks)
    return best.select(
        F.col("queryId").alias("movieId"),
        F.col("id").alias("neighborId"),
        F.col("score").alias("similarity"),
        "rank",
    )


def _nearest(found: list[tuple], top_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``top_n`` nearest of each item, nearest first, ties to the smaller id."""
    one, two, near = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((two, -np.round(near, SCORE_DIGITS), one))
    place = np.arange(order.size) - np.searchsorted(one[order], one[order])
    best = order[place < top_n]
    return one[best], two[best], near[best]


def _bucket_tile(top_n: int | None, radius: float):
    schema = pa.schema([("movieId", pa.int64()), ("neighborId", pa.int64()), ("similarity", pa.float64())])

    def pairs_within(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        ids = table["id"].to_numpy()
        vectors = table["unit"].combine_chunks()
        m = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        left, right = side <= 1, side >= 1
        a, b = ids[left], ids[right]
        am, bm = m[left], m[right]
        lengths_b = (bm * bm).sum(axis=1)
        found, held = [], 0
        both_ways = not (side == 1).any()
        strip = max(1, 4_000_000 // max(1, len(b)))
        for at in range(0, len(a), strip):
            part = am[at : at + strip]
            squared = (part * part).sum(axis=1)[:, None] + lengths_b[None, :] - 2.0 * (part @ bm.T)
            r, c = np.nonzero(squared < radius * radius)
            near = 1.0 - np.maximum(squared[r, c], 0.0) / 2.0
            one, two = a[at + r], b[c]
            keep = one != two
            one, two, near = one[keep], two[keep], near[keep]
            found.append((one, two, near))
            if both_ways:
                found.append((two, one, near))
            held += len(near) * (1 + both_ways)
            if top_n is not None and held > HELD_PAIRS:
                found = [_nearest(found, top_n)]
                held = len(found[0][0])
        if top_n is not None:
            return pa.Table.from_arrays([pa.array(x) for x in _nearest(found, top_n)], schema=schema)
        one, two, near = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        if len(np.unique(a)) < len(a) or len(np.unique(b)) < len(b):  # an id's rows are all in this tile
            order = np.lexsort((-near, two, one))
            one, two, near = one[order], two[order], near[order]
            first = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[: len(one)]
            one, two, near = one[first], two[first], near[first]
        return pa.Table.from_arrays([pa.array(x) for x in (one, two, near)], schema=schema)

    return pairs_within


def _near_in_parts(members: DataFrame, radius: float, top_n: int | None, once: bool = False) -> DataFrame:
    """``movieId, neighborId, similarity`` of unit vectors that share a bucket and lie within
    ``radius``; each task keeps the best ``top_n`` per item (None: all).

    ``members`` is ``table, bucket, parts, id, unit``.  A bucket is cut into its number of parts
    and each pair of parts is a group of its own, so no group is larger than two parts however
    full one bucket is.  With ``once`` all members share one bucket and ``top_n`` is None: a pair of ids then
    comes from one task only, and no pair is shuffled.
    """
    cut = members.withColumn("__own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    cut = cut.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own, other = F.col("__own"), F.col("__other")
    tiled = cut.select(
        "table",
        "bucket",
        F.least(own, other).alias("__a"),
        F.greatest(own, other).alias("__b"),
        F.when(own == other, 1).when(own < other, 0).otherwise(2).alias("side"),
        "id",
        "unit",
    )
    found = tiled.groupBy("table", "bucket", "__a", "__b").applyInArrow(
        _bucket_tile(top_n, radius), "movieId bigint, neighborId bigint, similarity double"
    )
    if once:
        return found.withColumn("similarity", rounded(F.col("similarity")))
    return found.groupBy("movieId", "neighborId").agg(rounded(F.max("similarity")).alias("similarity"))


def radius_pairs(factors: DataFrame, cos_threshold: float, bucket_rows: int | None = None) -> DataFrame:
    """Exactly the ordered pairs whose cosine exceeds ``cos_threshold``: what LSH approximates.

    All vectors share one bucket, which is cut into parts like any full bucket.
    """
    n, width = factors.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    slots = 4 * parallelism(factors.sparkSession)
    parts = ceil(max(1, n) / bucket_rows) if bucket_rows else block_count(n, min(BUCKET_ROWS, rows_per_block(width)), slots)
    unit = with_unit_vector(factors.where(F.col("features").isNotNull()), "features", "unit_vec")
    members = unit.select(
        F.col("id").cast("bigint").alias("id"),
        vector_to_array("unit_vec").alias("unit"),
        F.lit(0).alias("table"),
        F.lit(0).cast("bigint").alias("bucket"),
        F.lit(parts).alias("parts"),
    )
    return _near_in_parts(members, radius_for_cosine(cos_threshold), None, once=True)


def lsh_neighbors(
    factors: DataFrame,
    top_n: int = TOP_N,
    bucket_length: float = BUCKET_LENGTH,
    num_hash_tables: int = HASH_TABLES,
    cos_threshold: float = COS_THRESHOLD,
    seed: int = 42,
    bucket_rows: int | None = None,
) -> DataFrame:
    """Approximate neighbours with cosine above ``cos_threshold``: pairs that share a bucket in
    one of the hash tables.

    The hashing is Spark's random projection LSH.  Its own similarity join would send every pair
    of a bucket through the shuffle, and one bucket may hold a third of all vectors; here full
    buckets are cut up and only the best ``top_n`` partners leave a task.
    """
    unit = with_unit_vector(factors.where(F.col("features").isNotNull()), "features", "unit_vec")
    lsh = BucketedRandomProjectionLSH(
        inputCol="unit_vec",
        outputCol="hashes",
        bucketLength=bucket_length,
        numHashTables=num_hash_tables,
        seed=seed,
    )
    hashed = lsh.fit(unit).transform(unit)
    members = hashed.select(
        F.col("id").cast("bigint").alias("id"),
        vector_to_array("unit_vec").alias("unit"),
        F.posexplode("hashes").alias("table", "hash"),
    ).withColumn("bucket", vector_to_array("hash")[0].cast("bigint")).drop("hash")
    if bucket_rows is None:
        bucket_rows = min(BUCKET_ROWS, rows_per_block(factors.agg(F.max(F.size("features"))).first()[0]))
    # Every bucket with more rows than one part holds; stored, so the join is planned by its size.
    sizes = members.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("size"))
    full = settle(sizes.where(F.col("size") > bucket_rows), "full-buckets")
    parts = F.ceil(F.coalesce("size", F.lit(1)) / F.lit(bucket_rows)).cast("int")
    members = members.join(full, ["table", "bucket"], "left").withColumn("parts", parts)
    found = _near_in_parts(members, radius_for_cosine(cos_threshold), top_n)
    return _ranked(found, top_n)


def precompute_neighbors(
    factors: DataFrame, top_n: int = TOP_N, method: str = "auto", **options
) -> DataFrame:
    """``method``: ``exact``, ``lsh``, or ``auto``, which is exact at every size.

    The exact lists are made by many tasks, so there is no size at which they must be given up.
    """
    if method not in ("auto", "exact", "lsh"):
        raise ValueError("method must be 'auto', 'exact' or 'lsh'")
    build = lsh_neighbors if method == "lsh" else factor_neighbors
    return build(factors, top_n, **options)
