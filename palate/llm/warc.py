"""WARC archives with an index: written once per page, read back by coalesced byte ranges.

Each record is a gzip member of its own.  The index row of a record (file, offset, length, URL,
digest) is what the writing task returns, so the index names exactly the records of the attempts
that count.  A reader selects index rows, sorts them by place, merges neighbours into reads and
opens nothing else.

Of equal payloads (by SHA-1 and length) the first by page id is stored; the others are ``revisit``
records that name it and hold no payload.

Defined cases: a null page is an empty payload; pages of null id come last among equals, and a
revisit of one refers to null; of rows with equal ids the first in storage is stored; a null URL has
no target line, and control characters, spaces and other characters beyond ASCII are percent-encoded; an empty table gives
an empty index; other columns are not archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm.common import ROW, with_row_id
from palate.llm.files import Roll, coalesced, read_at
from palate.session import settle, shuffle_partitions, work_path

#: Bytes of an archive before a new one is begun; bytes of one read; bytes skipped rather than read apart.
ARCHIVE = 128 << 20
READ = 8 << 20
GAP = 64 << 10
LEVEL = 1
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SAFE = "".join(chr(c) for c in range(33, 127))
_INDEX = "file string, offset long, length long, url string, digest string, record_type string"
_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_SAFE)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {_name(first)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record that ``record`` wrote."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x[16:]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
    number = lambda name: int(name[10:-1]) if len(name) > 11 else None
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": url, "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def decisions(pages: DataFrame, least: int = 0) -> DataFrame:
    """``__file, __row, __first`` of the rows that only refer to another: equal payloads of ``least`` bytes or more."""
    html = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    slim = pages.select(*ROW, "page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("bytes"))
    slim = settle(slim.where(F.col("bytes") >= least), "digests")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", *ROW)
    firsts = slim.groupBy("digest", "bytes").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = slim.join(settle(firsts, "firsts"), ["digest", "bytes"])
    here = (F.col(ROW[0]) == F.col(f"first.{ROW[0]}")) & (F.col(ROW[1]) == F.col(f"first.{ROW[1]}"))
    return pairs.where(~here).select(*ROW, F.lit(True).alias("__revisit"), F.col("first.page_id").alias("__first"))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Archive ``pages`` (``page_id, url, html``) below ``folder``; returns the stored index."""
    rows = with_row_id(pages.select("page_id", "url", "html"))
    joined = rows.join(settle(decisions(rows, least), "revisits"), ROW, "left")
    ready = joined.select(
        F.col("page_id").cast("string").alias("id"), "url", F.coalesce("html", F.lit("")).alias("html"),
        F.coalesce("__revisit", F.lit(False)).alias("revisit"), F.col("__first").cast("string").alias("first"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll = Roll(folder, ".warc.gz", ARCHIVE)
        for batch in batches:
            out = []
            for page, url, html, revisit, first in batch.itertuples(index=False):
                payload = html.encode("utf-8", "surrogatepass")
                digest = base32_sha1(payload)
                number = lambda x: None if x is None else int(x)
                raw = gzip.compress(record(number(page), url, payload, digest, number(first), revisit), LEVEL, mtime=0)
                out.append((*roll.append(raw), len(raw), url, digest, "revisit" if revisit else "response"))
            roll.flush()
            yield pd.DataFrame(out, columns=["file", "offset", "length", "url", "digest", "record_type"])
        roll.close()

    return settle(ready.mapInPandas(run, _INDEX), "warc-index")


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the rows of ``index`` name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, start, stop, records in batch.itertuples(index=False):
                data = read_at(file, start, stop - start)
                out = [parse(gzip.decompress(data[r["offset"] - start : r["offset"] - start + r["length"]])) for r in records]
                frame = pd.DataFrame(out)
                for c in ("page_id", "refers_to"):
                    frame[c] = frame[c].astype("Int64")
                yield frame if payloads else frame.assign(payload=None)

    # Dealt by the bytes to read, not by the size of the index, which says nothing about them.
    spark = index.sparkSession
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(shuffle_partitions(spark), -(-size // READ))
    reads = coalesced(index, [], GAP, READ).repartition(tasks, "file", "start")
    return reads.mapInPandas(run, _RECORDS)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), work_path(spark, "warc"))
    return read_archives(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM x"""
