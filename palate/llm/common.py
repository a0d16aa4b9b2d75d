"""Small helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.session import settle

#: ASCII white space, as every word rule of this subpackage means it.
WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of UTF-8 text for splitting into words of digits, a to z and all beyond ASCII: A to Z in lower
#: case, any other ASCII a space.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)

#: Names of the columns that identify a row of a stored table.
ROW = ["__file", "__row"]


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def same(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of equal names where null meets null; ``right``'s copies are dropped."""
    renamed = right.select([F.col(c).alias(f"__r_{c}") if c in names else F.col(c) for c in right.columns])
    on = None
    for c in names:
        here = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        on = here if on is None else on & here
    return left.join(renamed, on, how).drop(*[f"__r_{c}" for c in names])


def with_row_id(df: DataFrame) -> DataFrame:
    """Add ``__file`` and ``__row``: where the row lies in storage, the same in every evaluation.

    Ids in a table may be null or repeat, so decisions about rows are joined back by position.
    A frame that is not a plain read of a Parquet table is stored first.
    """
    place = [F.xxhash64("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1])]
    try:
        out = df.select("*", *place)
        out.schema  # noqa: B018  (resolves the columns now)
        return out
    except PySparkException:
        return settle(df, "rows").select("*", *place)


def map_text(docs: DataFrame, keep: list[str], made: str, start: Callable[[], Callable[[list[str]], list[pa.Array]]],
             text: str = "text", at_once: int = 1000) -> DataFrame:
    """``keep`` as it is, and the columns ``made`` (DDL) that a function of the texts gives.

    ``start`` is called once per task and returns that function, which gets ``at_once`` texts at a
    time (null: empty) and returns one array per new column.  Its attribute ``done``, if it has one,
    is called when the task has no more texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                new = work(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], [*keep, *names])
        getattr(work, "done", int)()

    names = [x.split()[0] for x in made.split(",")]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    return docs.select(*keep, text_of(text).alias("__text")).mapInArrow(run, ", ".join([*kept, made]))


def ranked(df: DataFrame, group: list[str], order: list[Column], start: int = 0, name: str = "slot",
           rows_per_task: int = 1000) -> DataFrame:
    """Gapless numbers within each group, a group of any size being spread over many tasks.

    Rows are dealt to buckets by the hash of their first order column, buckets are counted, and a
    bucket's numbers follow those of the buckets before it.  ``df`` must give the same rows each time.
    """
    n = df.count()
    buckets = max(1, -(-n // rows_per_task))
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(order[0]), F.lit(buckets)))
    counts = dealt.groupBy(*group, "__bucket").agg(F.count("*").alias("__n"))
    from pyspark.sql import Window as W

    before = W.partitionBy(*group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select(*group, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = W.partitionBy(*group, "__bucket").orderBy(*order)
    numbered = dealt.withColumn("__i", F.row_number().over(inside))
    out = same(numbered, bases, [*group, "__bucket"])
    return out.withColumn(name, F.col("__base") + F.col("__i") + F.lit(start - 1)).drop("__bucket", "__base", "__i")
