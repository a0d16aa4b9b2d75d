"""Top-k with a total order, lookups bounded by k, and joins that survive hot keys."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.session import settle, shuffle_partitions

SCORE_DIGITS = 6

#: Longest list that is cut by shards before it is sorted.
SHARDED_K = 200

#: Rows up to which a list is broadcast without asking the optimizer.
BROADCAST_ROWS = 100_000


def rounded(score: Column, digits: int = SCORE_DIGITS) -> Column:
    """Scores are compared rounded so that summation order never changes a ranking.

    Values built from numbers that are themselves rounded to six decimals need more ``digits``:
    their exact results fall on half units of the sixth.
    """
    return F.round(score, digits)


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """Global top-k with a 1-based rank.  The window only ever sees the k kept rows."""
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def top_k_per(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """Top-k per key.  ``row_number() <= k`` lets Spark cut every map task to k rows per key
    before the shuffle, so a key that owns a third of the rows costs k rows per task."""
    keys = [key] if isinstance(key, str) else list(key)
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(rank) <= k)


def top_k_of_many(
    df: DataFrame, key: str, score: str, tie: str, k: int, digits: int = SCORE_DIGITS, rank: str = "rank"
) -> DataFrame:
    """Top-k per key by rounded ``score`` descending and ``tie`` ascending where keys own far more than k rows.

    Rounding and sorting all rows to keep few of them is what costs.  So the rows are stored, and the
    best score in each of some shards of a key's rows is found by hashing alone: the k-th best of
    these is a bound that at least k rows reach.  Only rows that can reach it once rounded are rounded
    and sorted.  Keys with rows in fewer than k shards keep them all.
    """
    order = [F.desc(score), F.asc(tie)]
    if k > SHARDED_K:
        return top_k_per(df.withColumn(score, rounded(F.col(score), digits)), key, order, k, rank)
    stored = settle(df, "scored")
    shard = F.pmod(F.xxhash64(tie), F.lit(3 * k))
    best = stored.groupBy(key, shard.alias("__shard")).agg(F.max(score).alias("__best"))
    falling = F.sort_array(F.collect_list("__best"), asc=False)  # 3 * k values at most
    bound = F.get(falling, F.lit(k - 1)) - F.lit(10.0**-digits)
    bounds = settle(best.groupBy(key).agg(bound.alias("__bound")), "bounds")
    reached = stored.join(bounds, key).where(F.col("__bound").isNull() | (F.col(score) >= F.col("__bound")))
    return top_k_per(reached.drop("__bound").withColumn(score, rounded(F.col(score), digits)), key, order, k, rank)


def numbered(df: DataFrame, order: Sequence[Column], name: str = "n") -> DataFrame:
    """Gapless numbers from 1 on in a total order of all rows, made by many tasks; a stored table.

    Range partitions are sorted each for itself, and a partition's numbers follow those of the
    partitions before it.  The window sees one row per partition.
    """
    line = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # the partition's number above the low 33 bits, the row's in them
    stored = settle(
        line.withColumn("__part", F.shiftright(place, 33)).withColumn("__row", place.bitwiseAND((1 << 33) - 1)), "ordered"
    )
    sizes = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    placed = stored.join(F.broadcast(bases), "__part")  # one row per partition
    return placed.withColumn(name, F.col("__base") + F.col("__row") + 1).drop("__part", "__row", "__base")


def as_list_column(df: DataFrame, size_bound: int) -> Column:
    """A small ranked table as one constant array column (scalar subquery, no join).

    ``df`` must hold at most ``size_bound`` rows, which has to be small enough to ship.
    """
    if size_bound > BROADCAST_ROWS:
        raise ValueError(f"{size_bound} rows are too many for a constant list")
    packed = df.limit(size_bound).agg(F.collect_list(F.struct(*df.columns)).alias("packed"))
    return packed.scalar()


def lookup_for(small: DataFrame, size_bound: int, dim: DataFrame, key: str) -> DataFrame:
    """Left join of at most ``size_bound`` rows with a dimension of any size.

    A left join cannot broadcast its left side, so the dimension is first cut down to the
    keys wanted by a semi join that broadcasts them; the join then only meets those rows.
    """
    if size_bound > BROADCAST_ROWS:
        return small.join(dim, key, "left")
    wanted = dim.join(F.broadcast(small.select(key).distinct()), key, "left_semi")
    return small.join(wanted, key, "left")


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Join on ``key`` when some keys of ``fact`` may own very many of its rows.

    A key of ``n`` rows is spread over ``ceil(n / rows_per_task)`` tasks by the hash of
    ``spread_by``, and only the ``dim`` rows of such keys are copied, once per task.  The keys are
    counted once and stored, so the planner sees their true size: it broadcasts them if they are
    few, and otherwise joins by exchanges that adaptive execution can split.
    """
    counts = fact.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_task)).cast("int").alias("__copies"))
    hot = settle(counts.where(F.col("__copies") > 1), "hot-keys")
    copies = F.coalesce("__copies", F.lit(1))
    salted_fact = fact.join(hot, key, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(spread_by), copies).cast("int")
    )
    salted_dim = dim.join(hot, key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), copies - 1))
    )
    return (
        salted_fact.drop("__copies").join(salted_dim.drop("__copies"), [key, "__salt"], how).drop("__salt")
    )
