"""The stored rating matrix: laid out once by item and once by user, so that repeated work on either key
needs no exchange of the entries.

Each layout is a table bucketed by its key.  A bucket is read by one task, so keys that own more than a
share of all entries are kept beside the buckets in a plain table, which any number of tasks read; there
are fewer such keys than ``1 / share``, which bounds what is sent to all tasks for them.

Defined cases: rows without a user, an item or a rating are left out; repeated pairs follow
``dup_policy``; an empty table gives an empty matrix; columns beside the three are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palate.operators.weighting import rating_entries
from palate.session import settle, shuffle_partitions, work_path

#: Entries that a bucket should hold; a key is hot that owns more than a share of all entries and of a bucket.
BUCKET_ROWS = 4_000_000
HOT_SHARE = 1 / 256
HOT_ROWS = BUCKET_ROWS // 4
SIDES = ("movieId", "userId")


@dataclass(frozen=True)
class Layout:
    """The entries by one key: ``cold`` is bucketed by it, ``hot`` holds the keys that own very many."""

    key: str
    cold: DataFrame
    hot: DataFrame

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot)

    def totals(self, *aggregates: Column) -> tuple[DataFrame, DataFrame]:
        """One row per key, of the cold and of the hot keys: the first without an exchange, the second
        with partial sums.  No key is in both."""
        return tuple(side.groupBy(self.key).agg(*aggregates) for side in (self.cold, self.hot))

    def with_totals(self, *aggregates: Column) -> DataFrame:
        """The entries, each with its key's totals."""
        cold, hot = self.totals(*aggregates)
        few = F.broadcast(hot)  # fewer than 1 / share keys
        return self.cold.join(cold, self.key).unionByName(self.hot.join(few, self.key))

    def of(self, keys: DataFrame) -> DataFrame:
        """The entries of the keys asked for (distinct or not); the entries stay where they are."""
        wanted = keys.select(self.key).distinct()
        return self.cold.join(wanted, self.key, "left_semi").unionByName(self.hot.join(wanted, self.key, "left_semi"))


@dataclass(frozen=True)
class StoredMatrix:
    """Both layouts, and where they lie."""

    path: str
    buckets: int
    by_item: Layout
    by_user: Layout


def _name(path: str, key: str) -> str:
    return f"palate_{md5(path.encode()).hexdigest()}_{key.lower()}"


def _schema(entries: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entries)


def open_matrix(spark: SparkSession, path: str, buckets: int) -> StoredMatrix:
    """A matrix written before, by this session or another; ``buckets`` is the number it was written with."""
    layouts = []
    for key in SIDES:
        hot = spark.read.parquet(f"{path}/hot-{key}")
        name = _name(path, key)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_schema(hot.schema)}) USING PARQUET"
            f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}/by-{key}'"
        )
        layouts.append(Layout(key, spark.table(name), hot))
    return StoredMatrix(path, buckets, *layouts)


def store_matrix(
    ratings: DataFrame,
    dup_policy: str = "sum",
    weighting: str = "none",
    path: str | None = None,
    buckets: int | None = None,
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
) -> StoredMatrix:
    """Write the matrix below ``path`` (a new folder of the work folder if not given).

    Entries are dealt to their buckets by the key before they are written, so that a bucket is one file.
    """
    spark = ratings.sparkSession
    entries = rating_entries(ratings, dup_policy, weighting)
    path = path or work_path(spark, "matrix")
    n = entries.count()
    buckets = buckets or max(shuffle_partitions(spark), ceil(n / BUCKET_ROWS))
    for key in SIDES:
        owned = entries.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max(n * hot_share, hot_rows))
        crowded = F.broadcast(settle(owned.select(key), "hot-keys"))  # fewer than 1 / share
        entries.join(crowded, key, "left_semi").write.parquet(f"{path}/hot-{key}")
        cold = entries.join(crowded, key, "left_anti").repartition(buckets, key)
        writer = cold.write.format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{path}/by-{key}").saveAsTable(_name(path, key))
    return open_matrix(spark, path, buckets)


def matrix_norms(matrix: StoredMatrix) -> DataFrame:
    """``movieId, norm, raters`` as ``ratings.item_norms`` gives them."""
    cold, hot = matrix.by_item.totals(*_norm())
    return cold.unionByName(hot)


def entries_with_norms(matrix: StoredMatrix) -> DataFrame:
    """``movieId, userId, rating, norm, raters``."""
    return matrix.by_item.with_totals(*_norm())


def _norm() -> list[Column]:
    x = F.col("rating").cast("double")
    return [F.sqrt(F.sum(x * x)).alias("norm"), F.count(F.lit(1)).alias("raters")]


def user_profiles(matrix: StoredMatrix) -> DataFrame:
    """``userId, n, mean, best``: how many items a user rated, their mean and highest entry."""
    facts = [F.count(F.lit(1)).alias("n"), F.avg("rating").alias("mean"), F.max("rating").alias("best")]
    cold, hot = matrix.by_user.totals(*facts)
    return cold.unionByName(hot)
