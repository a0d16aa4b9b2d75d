"""A table kept as deltas of changed rows, for streams whose aggregates are still moving.

Layout below ``root``::

    runs/<stream id>                          the run's place in the order of runs, written once
    generation=<g>/run=<stream id>/batch=<b>  the rows that a micro-batch changed
    generation=<g>/base                       everything before, folded to one row per key

The newest row of a key is the one of the latest run and, within it, the latest batch; every row
carries both numbers, so folding keeps them.  A repeated batch overwrites itself.  After ``most``
deltas the writer folds all rows into the base of the next generation; it counts from the moment its
write is complete, and the generation before the last is removed, so readers of the last one may
finish and the number of files stays bounded.

One stream writes to a root at a time; readers need no care.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.sources.readers import path_exists

#: Deltas after which they are folded.
MOST = 50
ORDER = ("__run", "__batch")


def _children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names in a folder that begin with ``prefix``; a folder that does not exist is empty."""
    if not path_exists(spark, path):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(where)]
    return [n for n in names if n.startswith(prefix)]


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _generation(spark: SparkSession, root: str) -> int:
    """The newest generation whose base is complete; 0 needs none."""
    numbers = sorted((int(n.split("=")[1]) for n in _children(spark, root, "generation=")), reverse=True)
    complete = (g for g in numbers if g and path_exists(spark, f"{root}/generation={g}/base/_SUCCESS"))
    return next(complete, 0)


def _ordinal(spark: SparkSession, root: str, run: str) -> int:
    """The run's place in the order in which runs first wrote here."""
    runs = f"{root}/runs"
    known = {}
    if _children(spark, runs, ""):
        known = {r["run"]: r["ordinal"] for r in spark.read.parquet(f"{runs}/*").collect()}  # one row per run
    if run not in known:
        known[run] = 1 + max(known.values(), default=0)
        spark.createDataFrame([(run, known[run])], "run STRING, ordinal LONG").coalesce(1).write.parquet(f"{runs}/{run}")
    return known[run]


def write_delta(rows: DataFrame, root: str, run: str, batch: int, keys: Sequence[str] = (), most: int = MOST) -> None:
    """Store what a micro-batch changed; with ``keys``, fold when ``most`` deltas have gathered."""
    spark = rows.sparkSession
    ordinal = _ordinal(spark, root, run)
    home = f"{root}/generation={_generation(spark, root)}"
    marked = rows.withColumn(ORDER[0], F.lit(ordinal).cast("long")).withColumn(ORDER[1], F.lit(batch).cast("long"))
    marked.write.mode("overwrite").parquet(f"{home}/run={run}/batch={batch}")
    if keys and len(_delta_paths(spark, home)) >= most:
        fold(spark, root, keys)


def _delta_paths(spark: SparkSession, home: str) -> list[str]:
    runs = _children(spark, home, "run=")
    return [f"{home}/{r}/{b}" for r in runs for b in _children(spark, f"{home}/{r}", "batch=")]


def _rows(spark: SparkSession, root: str) -> DataFrame:
    generation = _generation(spark, root)
    home = f"{root}/generation={generation}"
    paths = _delta_paths(spark, home) + ([f"{home}/base"] if generation else [])
    if not paths:
        raise ValueError(f"nothing was written to {root}")
    return spark.read.parquet(*paths)


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*values), F.struct(*ORDER)).alias("__newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__newest.{c}").alias(c) for c in values])


def read_newest(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key."""
    return _newest(_rows(spark, root), keys).drop(*ORDER)


def read_all(spark: SparkSession, root: str) -> DataFrame:
    """Every stored row with its run and batch, for tables whose reader chooses by itself."""
    return _rows(spark, root)


def fold(spark: SparkSession, root: str, keys: Sequence[str]) -> None:
    """Fold all rows into the base of the next generation and drop the generation before the last."""
    last = _generation(spark, root)
    _newest(_rows(spark, root), keys).write.mode("overwrite").parquet(f"{root}/generation={last + 1}/base")
    if last and path_exists(spark, f"{root}/generation={last - 1}"):
        _remove(spark, f"{root}/generation={last - 1}")
