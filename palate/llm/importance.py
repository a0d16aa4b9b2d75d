"""Importance resampling towards a target distribution, over hashed n-grams.

A document's features are its runs of one to three consecutive words; a feature falls into one of
``BUCKETS`` buckets by the CRC-32 of its bytes.  A bucket's gain is the logarithm of how much likelier
it is in the target texts than in all documents, and a document's weight is the sum of the gains of
its features.  Weights plus Gumbel noise from a hash of the id rank the documents, and the highest
scores are a sample without replacement in proportion to importance.

Features are interned batch by batch in an open-addressed NumPy table.  A feature is a slice of the
batch's cleaned bytes; its key is the XXH64 of the slice, its slot the next free place from the key
on, and equal keys count as the same feature only if their bytes are equal.  A slot stores the
feature's bucket, worked out once for however many occurrences, and their count.  Counting adds the
slots' counts into buckets; weighing gives every slot its bucket's gain, which occurrences gather by
slot number.  Batches are bounded, so memory does not grow with texts or vocabulary, and nothing but
the bucket counts (a fixed number of rows) leaves a task when counting.

The order of all scores is made by range partitions, whose sizes are added up before them, so no
task sees more than its range and equal scores may spread over several.

Defined cases: null and empty texts have no words, no features and weight 0; documents under
``least`` words get a score and no rank; a null id is hashed like an empty one and comes behind equal
scores; rows that are alike in everything are ranked by their place in storage; an empty table gives
an empty result, and empty target texts give every bucket its smoothed share.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palate.llm.common import LETTERS, ROW, map_text, text_of, with_row_id
from palate.session import settle, shuffle_partitions

BUCKETS = 10_000
ORDERS = 3
LEAST = 20
PERCENT = 5
#: Words, and bytes, at which a batch of features begins.
WORDS_AT_ONCE, BYTES_AT_ONCE = 1 << 16, 1 << 21
#: Longer features, and those of batches that a giant word fills, are hashed one by one.
SHORT = 31
#: The five primes of XXH64 and the reflected polynomial of CRC-32.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
POLYNOMIAL = 0xEDB88320


def _crc_table(bits: int) -> np.ndarray:
    """What ``bits`` bits at the low end of a CRC become once shifted out."""
    table = np.arange(1 << bits, dtype=np.uint32)
    for _ in range(bits):
        table = np.where(table & 1, table >> 1 ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


class Slices:
    """Slices of a byte buffer, ordered by length so that equal lengths are worked on together."""

    def __init__(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(np.minimum(lengths, SHORT + 1).astype(np.uint8), kind="stable")
        self.raw = buffer.tobytes()
        self.starts, self.lengths = starts[self.order], lengths[self.order]
        if len(buffer) <= 2 * BYTES_AT_ONCE:
            padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
            # The eight bytes from every place on, as one number each.
            self.eight = np.ascontiguousarray(np.ndarray(len(buffer) + 1, "<u8", padded, strides=(1,)))
            self.longest = SHORT
        else:
            self.eight, self.longest = None, 0

    def lane(self, at: np.ndarray, n: int = 8) -> np.ndarray:
        """The ``n`` bytes at each place as a number."""
        wide = self.eight[at]
        return wide if n == 8 else wide & np.uint64((1 << 8 * n) - 1)

    def groups(self, rows: np.ndarray | None = None) -> Iterator[tuple[int, slice]]:
        """``length, part`` for each length up to ``longest`` among ``rows`` (ascending), then 0 with the rest."""
        sizes = self.lengths if rows is None else self.lengths[rows]
        edges = np.searchsorted(np.minimum(sizes, SHORT + 1), np.arange(1, self.longest + 2))
        for n, lo, hi in zip(range(1, self.longest + 1), edges, edges[1:], strict=False):
            if lo < hi:
                yield n, slice(lo, hi)
        if edges[-1] < len(sizes):
            yield 0, slice(edges[-1], len(sizes))

    def one(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.starts[i] + self.lengths[i]]

    def xxh64(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        for n, part in self.groups():
            if not n:
                out[part] = [xxhash.xxh64_intdigest(self.one(i)) for i in range(part.start, part.stop)]
                continue
            at = self.starts[part]
            h = np.full(len(at), P5 + np.uint64(n))
            for k in range(0, n - 7, 8):
                h ^= _turn(self.lane(at + k) * P2, 31) * P1
                h = _turn(h, 27) * P1 + P4
            k = n & ~7
            if n & 4:
                h ^= self.lane(at + k, 4) * P1
                h = _turn(h, 23) * P2 + P3
            for k in range(n & ~3, n):
                h ^= self.lane(at + k, 1) * P5
                h = _turn(h, 11) * P1
            h = (h ^ h >> np.uint64(33)) * P2
            h = (h ^ h >> np.uint64(29)) * P3
            out[part] = h ^ h >> np.uint64(32)
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the slices ``a`` (ascending) and ``b`` hold the same bytes."""
        out = (self.lengths[a] == self.lengths[b]) | (a == b)
        for n, part in self.groups(a):
            x, y = self.starts[a[part]], self.starts[b[part]]
            if not n:
                out[part] = [i == j or self.one(i) == self.one(j) for i, j in zip(a[part], b[part], strict=True)]
            elif n < 8:
                out[part] &= self.lane(x, n) == self.lane(y, n)
            else:
                for k in {*range(0, n - 7, 8), n - 8}:
                    out[part] &= self.lane(x + k) == self.lane(y + k)
        return out

    def crc32(self, rows: np.ndarray) -> np.ndarray:
        """CRC-32 of the slices ``rows`` (ascending)."""
        out = np.empty(len(rows), np.uint32)
        for n, part in self.groups(rows):
            if not n:
                out[part] = [zlib.crc32(self.one(i)) for i in rows[part]]
                continue
            at = self.starts[rows[part]]
            crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
            for k in range(0, n - 1, 2):
                crc = _CRC[16][(crc ^ self.lane(at + k, 2).astype(np.uint32)) & 0xFFFF] ^ crc >> 16
            if n & 1:
                crc = _CRC[8][(crc ^ self.lane(at + n - 1, 1).astype(np.uint32)) & 0xFF] ^ crc >> 8
            out[part] = ~crc
        return out


_CRC = {bits: _crc_table(bits) for bits in (8, 16)}


def _turn(h: np.ndarray, bits: int) -> np.ndarray:
    return h << np.uint64(bits) | h >> np.uint64(64 - bits)


class Table:
    """The different slices of a batch: ``slot`` of each occurrence, and of each slot ``bucket`` and ``count``."""

    def __init__(self, slices: Slices, buckets: int):
        n = len(slices.starts)
        keys = slices.xxh64()
        mask = (1 << (2 * n).bit_length()) - 1
        owner = np.full(mask + 1, -1, np.int32)
        place = np.empty(n, np.int64)
        left, at = np.arange(n, dtype=np.int32), (keys & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = owner[at] < 0
            owner[at[free]] = left[free]
            holder = owner[at]
            same = keys[holder] == keys[left]
            same[same] = slices.equal(left[same], holder[same])
            place[left[same]] = at[same]
            left, at = left[~same], (at[~same] + 1) & mask
        used = np.flatnonzero(owner >= 0)
        used = used[np.argsort(owner[used])]
        number = np.empty(mask + 1, np.int32)
        number[used] = np.arange(len(used))
        self.slot = np.empty(n, np.int32)
        self.slot[slices.order] = number[place]
        self.bucket = (slices.crc32(owner[used]) % np.uint32(buckets)).astype(np.int64)
        self.count = np.bincount(self.slot, minlength=len(used))


class Batch:
    """The words of some texts: cleaned bytes with one space between words, and where each word lies."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b"\n".join(texts).translate(LETTERS), np.uint8)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        space = joined == 32
        before = np.concatenate([[True], space[:-1]])
        firsts = np.flatnonzero(~space & before)
        self.owner = np.searchsorted(np.cumsum(sizes), firsts, "right")
        self.n_words = np.bincount(self.owner, minlength=len(texts))
        self.clean = joined[~(space & before)]
        space = self.clean == 32
        self.starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        self.ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1

    def tables(self, orders: int, buckets: int) -> Iterator[tuple[np.ndarray, Table]]:
        """``owners, table`` of bounded parts: which text each occurrence is of, and the interned features."""
        total, a = len(self.starts), 0
        while a < total:
            b = int(np.searchsorted(self.starts, self.starts[a] + BYTES_AT_ONCE))
            b = max(a + 1, min(b, a + WORDS_AT_ONCE))
            first, last = [], []
            for n in range(orders):
                i = np.arange(a, min(b, total - n))
                i = i[self.owner[i] == self.owner[i + n]]
                first.append(i)
                last.append(i + n)
            first, last = np.concatenate(first), np.concatenate(last)
            base, stop = self.starts[a], self.ends[last.max()]
            at = self.starts[first]
            yield self.owner[first], Table(Slices(self.clean[base:stop], at - base, self.ends[last] - at), buckets)
            a = b


def bucket_counts(df: DataFrame, text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: the features of all texts by bucket.  A task returns at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for _, table in Batch(batch.column(0).slice(at, 1000).to_pylist()).tables(orders, buckets):
                    total += np.bincount(table.bucket, table.count, buckets).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    parts = df.select(text_of(text).cast("binary").alias("__text")).mapInArrow(run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """A whole number per bucket from two tables ``bucket, n``, which have at most ``buckets`` rows each."""

    def dense(counts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for r in counts.collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = dense(raw), dense(target)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weights(docs: DataFrame, keep: list[str], gains: np.ndarray, text: str = "text", orders: int = ORDERS) -> DataFrame:
    """``keep``, ``n_words``, ``n_features`` and ``weight`` of each document."""

    def start():
        def work(texts: list[str]) -> list[pa.Array]:
            batch = Batch([t.encode("utf-8", "surrogatepass") for t in texts])
            features, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for owners, table in batch.tables(orders, len(gains)):
                each = gains[table.bucket]
                features += np.bincount(owners, minlength=len(texts))
                # Sums of whole numbers below 2^53, so these doubles are exact.
                weight += np.bincount(owners, each[table.slot], len(texts)).astype(np.int64)
            return [pa.array(x, pa.int64()) for x in (batch.n_words, features, weight)]

        return work

    return map_text(docs, keep, "n_words long, n_features long, weight long", start, text)


def draw(weighted: DataFrame, percent: int = PERCENT, least: int = LEAST, seed: int = 42) -> DataFrame:
    """Add ``score``, and ``rank`` from 1 on for the highest ``percent`` of the documents of ``least`` words.

    ``weighted`` has ``doc_id``, the columns of ``ROW``, ``n_words`` and ``weight``.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weighted.withColumn("score", F.col("weight") + noise).withColumn("__in", F.col("n_words") >= least)
    order = [F.desc("__in"), F.desc("score"), F.asc_nulls_last("doc_id"), *ROW]
    line = scored.repartitionByRange(shuffle_partitions(weighted.sparkSession), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # partition number above the low 33 bits, row number in them
    line = settle(line.withColumn("__part", F.shiftright(place, 33)).withColumn("__at", place.bitwiseAND((1 << 33) - 1)), "scores")
    sizes = line.groupBy("__part").agg(F.count("*").alias("__n"), F.count_if("__in").alias("__able"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # one row per range partition
    bases = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    drawn = F.expr(f"{percent} * sum(__able) DIV 100")
    most = sizes.agg(F.coalesce(drawn, F.lit(0))).first()[0]
    rank = F.col("__base") + F.col("__at") + 1
    out = line.join(F.broadcast(bases), "__part").withColumn("rank", F.when(F.col("__in") & (rank <= most), rank))
    return out.drop("__part", "__at", "__base", "__in")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST, seed: int = 42) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each document, towards the texts of ``target``."""
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    rows = with_row_id(docs.select("doc_id", "text"))
    # Stored, because range partitions are chosen from a pass of their own over the rows.
    return draw(settle(weights(rows, ["doc_id", *ROW], gains), "weights"), percent, least, seed).drop(*ROW)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
