"""Token counts of flat token files by a scan for separators.

A token file is nothing but numbers of a fixed width, each document ended by one separator; no index
says where documents begin.  Files are cut into blocks of equal size, and each block is searched for
separators by one vectorized comparison, wherever its tokens fall.  Documents that cross blocks are
stitched by a prefix scan over one small row per block: the number of separators before the block
gives its first document's number, and the last separator before it gives where that began.

Defined cases: tokens behind a file's last separator are a document of their own, marked as not
ended; two separators in a row bound an empty document; bytes at the end of a file that do not make a
token are ignored; an empty file has no documents.  On writing, null and empty texts are empty
documents, and repeated rows and null ids are written each.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palate.llm.common import map_text
from palate.llm.files import Roll, read_at
from palate.session import settle, shuffle_partitions, work_path

#: Bytes of a block, and of a token file before a new one is begun.
BLOCK = 4 << 20
FILE = 64 << 20
TYPE = "<u2"
#: Fixed value: the number that the byte-level vocabulary leaves free for the end of a text.
SEPARATOR = 50256


def write_token_files(docs: DataFrame, folder: str, ranks: str, separator: int = SEPARATOR, kind: str = TYPE) -> DataFrame:
    """Encode texts with a rank file and write flat token files; ``doc_id, file, ordinal`` of each, stored."""

    def start():
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        roll = Roll(folder, ".tokens", FILE)
        seen: dict[str, int] = {}

        def work(texts: list[str]) -> list[pa.Array]:
            files, numbers = [], []
            for t in texts:
                file, _ = roll.append(np.array([*encode(t), separator], kind).tobytes())
                name = file.rsplit("/", 1)[1]
                numbers.append(seen.get(name, 0))
                seen[name] = numbers[-1] + 1
                files.append(name)
            roll.flush()
            return [pa.array(files, pa.string()), pa.array(numbers, pa.int64())]

        work.done = roll.close
        return work

    return settle(map_text(docs, ["doc_id"], "file string, ordinal long", start), "token-files")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length`` of the token files in a folder; their contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder).select("path", "length")


def scan(files: DataFrame, separator: int = SEPARATOR, kind: str = TYPE, block: int = BLOCK) -> DataFrame:
    """``path, block, tokens, n, last, ends``: the separators' places in each block, counted from the file's start."""
    width = np.dtype(kind).itemsize
    per = max(1, block // width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, number, size in batch.itertuples(index=False):
                tokens = np.frombuffer(read_at(path, number * per * width, size * width), kind)
                ends = np.flatnonzero(tokens == separator) + number * per
                last = ends[-1:].tolist() or [None]
                yield pd.DataFrame({"path": [path], "block": [number], "tokens": [len(tokens)], "n": [len(ends)], "last": pd.array(last, "Int64"), "ends": [ends]})

    whole = files.select("path", F.expr(f"length DIV {width}").alias("__size")).where("__size > 0")
    blocks = whole.select("path", "__size", F.explode(F.sequence(F.lit(0), F.expr(f"CAST((__size - 1) DIV {per} AS INT)"))).alias("block"))
    sized = blocks.select("path", F.col("block").cast("long").alias("block"), F.least(F.lit(per), F.col("__size") - F.col("block") * F.lit(per)).alias("size"))
    dealt = sized.repartition(shuffle_partitions(files.sparkSession), "path", "block")
    return dealt.mapInPandas(run, "path string, block long, tokens long, n long, last long, ends array<long>")


def document_lengths(files: DataFrame, separator: int = SEPARATOR, kind: str = TYPE, block: int = BLOCK) -> DataFrame:
    """``path, ordinal, start, n_tokens, ended`` of each document of the files (``path, length``)."""
    found = settle(scan(files, separator, kind, block), "separators")
    line = W.partitionBy("path").orderBy("block")
    before = line.rowsBetween(W.unboundedPreceding, -1)
    slim = found.select("path", "block", "tokens", "n", "last")
    base: Column = F.coalesce(F.sum("n").over(before), F.lit(0))
    begun: Column = F.coalesce(F.last("last", ignorenulls=True).over(before) + 1, F.lit(0))
    carried = settle(slim.select("path", "block", base.alias("base"), begun.alias("begun")), "carried")
    places = found.where("n > 0").select("path", "block", "ends").join(carried, ["path", "block"])
    starts = F.concat(F.array("begun"), F.transform(F.expr("slice(ends, 1, size(ends) - 1)"), lambda x: x + 1))
    spans = places.select("path", "base", F.arrays_zip(starts.alias("start"), "ends").alias("spans"))
    each = spans.select("path", "base", F.posexplode("spans").alias("i", "s")).select("path", "base", "i", "s.start", F.col("s.ends").alias("stop"))
    ended = each.select("path", (F.col("base") + F.col("i")).alias("ordinal"), "start", (F.col("stop") - F.col("start")).alias("n_tokens"), F.lit(True).alias("ended"))
    files_end = slim.groupBy("path").agg(F.sum("tokens").alias("all"), F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"))
    rest = files_end.where(F.col("all") > F.col("start")).select("path", "ordinal", "start", (F.col("all") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(rest)


def ranks_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "tokens")
    written = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, ranks_file())
    lengths = document_lengths(token_files(spark, folder)) if written.count() else spark.createDataFrame([], "path string, ordinal long, n_tokens long")
    named = lengths.select(F.substring_index("path", "/", -1).alias("file"), "ordinal", "n_tokens")
    return written.join(named, ["file", "ordinal"]).select("doc_id", "n_tokens")
