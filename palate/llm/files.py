"""Byte files in the shared folder, written and read by tasks."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (local, HDFS, S3, GCS, Azure) or of an absolute local path."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


class Roll:
    """Appends records to files of ``most`` bytes or a little more.

    Every attempt of a task writes files of new names.  What counts is the table of records that the
    task returns: files of an attempt that failed are named by no row.
    """

    def __init__(self, folder: str, suffix: str, most: int):
        self.files, self.folder = place(folder)
        self.uri, self.suffix, self.most = folder, suffix, most
        self.out, self.at, self.name = None, 0, ""
        self.files.create_dir(self.folder, recursive=True)

    def append(self, record: bytes) -> tuple[str, int]:
        """The file and the offset of the record."""
        if self.out is not None and self.at >= self.most:
            self.close()
        if self.out is None:
            self.name, self.at = f"{uuid.uuid4().hex}{self.suffix}", 0
            self.out = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        at = self.at
        self.out.write(record)
        self.at += len(record)
        return f"{self.uri}/{self.name}", at

    def flush(self) -> None:
        """All that was appended is written; called before its rows are handed on."""
        if self.out is not None:
            self.out.flush()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def read_at(path: str, offset: int, length: int) -> bytes:
    files, inner = place(path)
    with files.open_input_file(inner) as f:
        return f.read_at(length, offset)


def coalesced(index: DataFrame, carried: list[str], gap: int, most: int) -> DataFrame:
    """``file, start, stop, records``: reads that cover the rows of an index (``file, offset, length``).

    Neighbours less than ``gap`` bytes apart are read together, up to about ``most`` bytes at once.
    ``records`` holds ``offset``, ``length`` and the carried columns of each record of a read.
    """
    line = W.partitionBy("file").orderBy("offset")
    end = F.max(F.col("offset") + F.col("length")).over(line.rowsBetween(W.unboundedPreceding, -1))
    apart = index.withColumn("__new", F.when(F.col("offset") - end > gap, 1).otherwise(0))
    runs = apart.withColumn("__run", F.sum("__new").over(line)).withColumn("__part", F.floor(F.col("offset") / most))
    return runs.groupBy("file", "__run", "__part").agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"),
        F.collect_list(F.struct("offset", "length", *carried)).alias("records"),
    ).select("file", "start", "stop", "records")
