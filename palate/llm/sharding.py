"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Documents of equal text form a group and go to one shard.  Packing looks at a bounded list of lots:
a group that holds over a ``LOTS``-th of anything is a lot of its own, and there are at most ``LOTS``
of those per dimension; all other groups are dealt to ``LOTS`` common lots by hash.  A group of more
than a shard's fair share in any dimension would tip the balance wherever it went, so it is split by
the hash of the id into parts that are lots; rows of an id that very many rows share (or of none)
by the hash of their place in storage, too.  Lots are placed from the largest down, each where the dot
product of its vector with the shard's residual capacity is highest; a shard that the lot would
overfill in bytes is taken only if every shard is.

Defined cases: a null text has size 1, CRC-32 0 and a group of its own; the empty text is another;
repeated rows are rows of their group; an empty table gives an empty result; other columns pass
through unless they bear the name of a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm.common import ROW, WORD, ranked, same, text_of, with_row_id
from palate.session import settle

SHARDS = 16
LOTS = 4096
RESULT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def place(lots: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each lot (rows: bytes, tokens, rows).  Ties go to the smaller shard."""
    total = np.maximum(lots.sum(axis=0), 1.0)
    scaled = lots / total * shards  # a shard's fair share is 1 in each dimension
    residual = np.ones((shards, lots.shape[1]))
    out = np.zeros(len(lots), np.int32)
    # Bytes come first: they are the law that must hold.
    for i in np.lexsort((np.arange(len(lots)), -scaled.sum(axis=1), -scaled[:, 0])):
        fits = residual[:, 0] >= scaled[i, 0]
        worth = residual @ scaled[i] if fits.any() else residual[:, 0].copy()
        worth[fits.any() & ~fits] = -np.inf
        best = int(worth.argmax())
        out[i] = best
        residual[best] -= scaled[i]
    return out


def pack(sized: DataFrame, shards: int = SHARDS, lots: int = LOTS) -> DataFrame:
    """``sized`` (``salt, group, bytes, tokens`` and others; a stored table) with ``shard``."""
    dims = ["bytes", "tokens", "rows"]
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    whole = sized.agg(*sums).first()
    total = {c: float(whole[c] or 0) for c in dims}
    groups = sized.groupBy("group").agg(*sums)
    over = lambda share: F.expr(" OR ".join(f"`{c}` > {share * total[c]!r}D" for c in dims))
    most = F.greatest(*[F.col(c) / F.lit(max(total[c], 1.0)) for c in dims])
    heavy = groups.where(over(1 / lots)).select(
        "group", F.when(most > 1 / shards, F.ceil(most * lots / 4)).otherwise(1).cast("int").alias("parts")
    )
    heavy = settle(heavy, "heavy")  # 3 * lots rows at most, by the share that each holds
    dealt = sized.join(F.broadcast(heavy), "group", "left")
    part = F.pmod(F.col("salt"), F.col("parts"))
    lot = F.when(F.col("parts").isNull(), F.format_string("c%d", F.pmod(F.xxhash64("group"), F.lit(lots))))
    dealt = dealt.withColumn("lot", F.coalesce(lot, F.concat(F.lit("g"), "group", F.lit("-"), part.cast("string")))).drop("parts")
    vectors = dealt.groupBy("lot").agg(*sums).orderBy("lot").toPandas()  # bounded by ``lots`` alone
    spark = sized.sparkSession
    if vectors.empty:
        return dealt.drop("lot").withColumn("shard", F.lit(0))
    chosen = place(vectors[dims].to_numpy(float), shards)
    placed = spark.createDataFrame([(n, int(s)) for n, s in zip(vectors["lot"], chosen, strict=True)], "lot string, shard int")
    return dealt.join(F.broadcast(placed), "lot").drop("lot")


def salted(rows: DataFrame, lots: int = LOTS) -> DataFrame:
    """Add ``salt``: a hash of the id, and of the row's place where an id is that of over a ``lots``-th of all rows."""
    n = rows.count()
    crowded = rows.groupBy("doc_id").agg(F.count("*").alias("__n")).where(F.col("__n") > max(n / lots, 1)).drop("__n")
    crowded = settle(crowded, "crowded-ids")  # ``lots`` rows at most, by the share that each holds
    marked = same(rows, F.broadcast(crowded.withColumn("__crowded", F.lit(True))), ["doc_id"], "left")
    salt = F.when(F.col("__crowded"), F.xxhash64("doc_id", *ROW)).otherwise(F.xxhash64("doc_id"))
    return marked.withColumn("salt", salt).drop("__crowded")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` without their text, with the columns of ``RESULT``."""
    carried = [c for c in docs.columns if c not in (*RESULT, "text", "group", "bytes", "tokens", "salt")]
    sized = settle(
        with_row_id(docs).select(
            *carried, *ROW,
            F.coalesce(F.md5("text"), F.lit("null")).alias("group"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("bytes"),
            F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("tokens"),
            F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
        ),
        "sized",
    )
    packed = settle(pack(salted(sized), shards), "packed")
    numbered = ranked(packed, ["shard"], [F.col("salt"), F.col("doc_id"), F.col("group"), *map(F.col, ROW)], name="slot")
    return numbered.select(
        *carried, F.col("bytes").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
