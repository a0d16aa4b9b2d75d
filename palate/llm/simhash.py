"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A text's fingerprint has a bit set where over half of its shingles' hashes have it.  Two fingerprints
are linked if they differ in at most four bits.

The 64 bits are cut into three segments of 22, 21 and 21 bits.  Every 23-bit word lies within three
bits of exactly one codeword of the binary Golay code.  A segment's keys are the codewords of the
segment itself and of each word one bit away: one to six of them, and two segments that differ in
two bits or less share one, that of the word between them.  Of four differing bits at most one
segment can hold three or more, so two segments agree in a key each: fingerprints meet in the
buckets of pairs of segment keys, where all pairs are compared bit by bit.

Equal fingerprints are one class from the start, so a bucket's size is a number of *different*
fingerprints.  Within a bucket a breadth-first walk compares them by blocks of numbers and gives one
link for each fingerprint reached, never all pairs; that keeps every component whole.  A bucket of more
than ``FULL`` is only counted at first: its fingerprints are then dealt to blocks, and each pair of
blocks is walked as a group of its own, so memory and the work of a task are bounded.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; a text of
fewer words than a shingle is one shingle; repeated rows fall into one class; documents of null id
take part in linking but never name a component, which is null if no id is left; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm.common import ROW, map_text, same, with_row_id
from palate.llm.components import components
from palate.session import settle, shuffle_partitions

SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Fixed value: generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
MOST = 4
#: Different fingerprints that a bucket is walked with as a whole; and those of a block of a fuller one.
FULL = 16_384
#: Shingles turned into bits at a time.
AT_ONCE = 1 << 16
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str, width: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the text's word shingles, as a signed number."""
    words = text.encode("utf-8", "surrogatepass").translate(_UPPER).split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, AT_ONCE):
        shingles = (b" ".join(words[i : i + width]) for i in range(at, min(n, at + AT_ONCE)))
        h = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = 4) -> DataFrame:
    """``keep`` and ``fp`` (signed) of each document."""

    def start():
        return lambda texts: [pa.array([fingerprint(t, width) for t in texts], pa.int64())]

    return map_text(docs, keep, "fp long", start, text)


def _remainders(words: np.ndarray) -> np.ndarray:
    out = words.copy()
    for bit in range(22, 10, -1):
        out = np.where(out >> bit & 1, out ^ (GENERATOR << (bit - 11)), out)
    return out


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and high 11 bits of a word, and the error word of each remainder."""
    low = _remainders(np.arange(1 << 12, dtype=np.int32))
    high = _remainders(np.arange(1 << 11, dtype=np.int32) << 12)
    one = 1 << np.arange(23, dtype=np.int32)
    two = (one[:, None] | one)[np.triu_indices(23, 1)]
    three = (two[:, None] | one).ravel()
    errors = np.concatenate([[0], one, two, three]).astype(np.int32)
    table = np.zeros(1 << 11, np.int32)
    table[(low[errors & 0xFFF] ^ high[errors >> 12])[::-1]] = errors[::-1]
    return low, high, table


def segment_keys(segment: np.ndarray, width: int, tables: tuple) -> np.ndarray:
    """Codeword numbers of each segment and its neighbours; a repeated key is -1."""
    low, high, table = tables
    near = np.concatenate([segment[:, None], segment[:, None] ^ (1 << np.arange(width, dtype=np.int32))], axis=1)
    keys = (near ^ table[low[near & 0xFFF] ^ high[near >> 12]]) >> 11
    keys.sort(axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def _bucket_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables = golay_tables()
    for batch in batches:
        for at in range(0, len(batch), 2000):
            fps = batch["fp"].to_numpy()[at : at + 2000]
            word = fps.astype(np.int64).view(np.uint64)
            keys = [segment_keys((word >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int32), w, tables) for s, w in SEGMENTS]
            for n, (i, j) in enumerate(PAIRS):
                both = (keys[i][:, :, None] << 12 | keys[j][:, None, :]) + (n << 24)
                row, a, b = np.nonzero((keys[i][:, :, None] >= 0) & (keys[j][:, None, :] >= 0))
                yield pd.DataFrame({"key": both[row, a, b].astype(np.int32), "fp": fps[row]})


def forest(fps: np.ndarray, most: int = MOST) -> list[tuple[int, int]]:
    """Links that join all that is joined among these different fingerprints, one less than each component's size."""
    left = fps.view(np.uint64)
    out = []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(left ^ x) <= most
            if near.any():
                reached = left[near]
                left = left[~near]
                frontier.extend(reached)
                me = int(x.astype(np.int64))
                out.extend((me, y) for y in reached.astype(np.int64).tolist())
    return out


def _bucket_links(most: int, full: int):
    """``u, v`` of links, and for each bucket of more than ``full`` fingerprints a row ``key`` with their number in ``u``."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pd.DataFrame:
        """Links of whole buckets, given sorted by key."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        u, v = [], []
        # Small buckets together: each row with the row d places on, if that is in the same bucket.
        small = np.repeat(sizes <= 16, sizes)
        k, f = keys[small], fps[small].view(np.uint64)
        for d in range(1, 16):
            if len(k) <= d:
                break
            hit = (k[d:] == k[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= most)
            u.append(f[d:][hit].view(np.int64))
            v.append(f[:-d][hit].view(np.int64))
        walked = (sizes > 16) & (sizes <= full)
        for s, n in zip(starts[walked], sizes[walked], strict=True):
            found = np.array(forest(fps[s : s + n], most), np.int64).reshape(-1, 2)
            u.append(found[:, 0])
            v.append(found[:, 1])
        out = pd.DataFrame({"u": np.concatenate(u or [keys[:0]]), "v": np.concatenate(v or [keys[:0]])}, dtype=np.int64)
        out = out.drop_duplicates()
        out["key"] = pd.Series(pd.NA, index=out.index, dtype="Int32")
        over = sizes > full
        return pd.concat([out, marks(keys[starts[over]], sizes[over])]) if over.any() else out

    def marks(keys: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"u": sizes.astype(np.int64), "v": 0, "key": pd.array(keys, "Int32")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, fps = np.zeros(0, np.int32), np.zeros(0, np.int64)
        counted, so_far = None, 0  # a bucket that is only counted
        for batch in batches:
            new_keys, new_fps = batch["key"].to_numpy(), batch["fp"].to_numpy()
            if counted is not None:
                same = int(np.searchsorted(new_keys, counted, "right"))
                so_far += same
                if same == len(new_keys):
                    continue
                yield marks(np.array([counted]), np.array([so_far]))
                counted, new_keys, new_fps = None, new_keys[same:], new_fps[same:]
            keys, fps = np.r_[keys, new_keys], np.r_[fps, new_fps]
            if len(keys) < 200_000:
                continue
            whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
            if whole:
                yield links(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
            if len(keys) > full:
                counted, so_far = int(keys[0]), len(keys)
                keys, fps = keys[:0], fps[:0]
        if counted is not None:
            yield marks(np.array([counted]), np.array([so_far]))
        if len(keys):
            yield links(keys, fps)

    return run


def _block_links(most: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = np.array(forest(rows["fp"].to_numpy(), most), np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": found[:, 0], "v": found[:, 1]})

    return run


def fingerprint_links(fps: DataFrame, most: int = MOST, full: int = FULL) -> DataFrame:
    """``u, v``: links that join exactly the fingerprints (column ``fp``, different) that links join."""
    if most > MOST:
        raise ValueError("the segments of this code find up to four differing bits")
    keyed = fps.select("fp").mapInPandas(_bucket_keys, "key int, fp long")
    n = shuffle_partitions(fps.sparkSession)
    buckets = keyed.repartition(n, "key").sortWithinPartitions("key")
    found = settle(buckets.mapInPandas(_bucket_links(most, full), "u long, v long, key int"), "bucket-links")
    links = found.where("key IS NULL").select("u", "v")
    over = settle(found.where("key IS NOT NULL").select("key", F.ceil(F.col("u") / F.lit(full)).cast("int").alias("blocks")), "full-buckets")
    if over.count():
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        dealt = keyed.join(over, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pairs = dealt.groupBy("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
        links = links.unionByName(pairs.applyInPandas(_block_links(most), "u long, v long"))
    return links.distinct()


def near_duplicates(fingerprinted: DataFrame, most: int = MOST) -> DataFrame:
    """``fp, n, component_id`` per fingerprint of ``fingerprinted`` (``doc_id, fp``): the least id reachable."""
    classes = settle(fingerprinted.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "classes")
    roots = settle(components(fingerprint_links(classes, most)), "components")
    joined = settle(classes.join(roots.withColumnRenamed("node", "fp"), "fp"), "linked")
    least = settle(joined.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    linked = settle(joined.join(least, "root").select("fp", "component_id"), "linked")
    return classes.join(linked.withColumn("__in", F.lit(True)), "fp", "left").select(
        "fp", "n", F.when(F.col("__in"), F.col("component_id")).otherwise(F.col("least")).alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, most: int = MOST) -> DataFrame:
    """One document of each component stays: the one of least id, of equal ids the first in storage."""
    rows = with_row_id(docs)
    marked = settle(fingerprints(rows, [*ROW, "doc_id"]), "fingerprints")
    classes = settle(near_duplicates(marked, most), "classes")
    crowded = classes.groupBy("component_id").agg(F.sum("n").alias("rows")).where("rows > 1 OR component_id IS NULL")
    crowded = settle(crowded, "crowded")
    inside = settle(marked.join(settle(same(classes, crowded, ["component_id"], "left_semi"), "crowded"), "fp"), "inside")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *ROW)).alias("first")
    group = F.when(F.col("component_id").isNull(), F.col("fp"))  # classes without any id are apart
    chosen = inside.groupBy("component_id", group.alias("apart")).agg(first).select(*[F.col(f"first.{c}").alias(c) for c in ROW])
    losers = settle(inside.select(*ROW).join(settle(chosen, "chosen"), ROW, "left_anti"), "losers")
    return rows.join(losers, ROW, "left_anti").select(docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marked = settle(fingerprints(docs, ["doc_id"]), "fingerprints")
    classes = settle(near_duplicates(marked).select("fp", "component_id"), "classes")
    return marked.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
