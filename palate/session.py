"""Where intermediate tables go, and small facts read from the caller's session."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A single-process master (``local[n]``), as in tests, may leave it unset: a folder is then made
    for it.  On any cluster an unset folder is an error, because a machine-local path dies with
    its machine.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="palate-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


#: Local property that names the folder of the workspace in force; threads of a job inherit it.
WORKSPACE = "palate.workspace"


def work_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the workspace in force, else below the checkpoint folder; nothing is created yet."""
    folder = spark.sparkContext.getLocalProperty(WORKSPACE) or f"{checkpoint_root(spark)}/palate"
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """Owner of the tables settled inside the block: they lie in one folder, deleted at its end.

    Whatever should outlive the block must be written (or collected) inside it: a table made inside
    still reads its intermediates.  The folder is deleted when the block fails, too.  Blocks nest; each
    thread has its own.
    """
    sc = spark.sparkContext
    outer = sc.getLocalProperty(WORKSPACE)
    folder = work_path(spark, "workspace")
    sc.setLocalProperty(WORKSPACE, folder)
    try:
        yield folder
    finally:
        sc.setLocalProperty(WORKSPACE, outer)
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def parallelism(spark: SparkSession) -> int:
    """Task slots the session can use at once."""
    return max(1, spark.sparkContext.defaultParallelism)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that is about to be read several times and return it from storage.

    The copy lies in the shared checkpoint folder, so a lost executor costs a re-read and not
    a recomputation, and every reader gets column pruning and true sizes for join planning.
    """
    spark = df.sparkSession
    path = work_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
