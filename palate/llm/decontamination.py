"""Benchmark decontamination by a Wu-Manber search for many passages at once.

A benchmark item's windows are its runs of ``width`` consecutive words; an item of fewer words is one
window.  A document's word is hit if it lies inside any occurrence of a window.

Windows are searched by their number of words, as patterns over the alphabet of words.  A cursor looks
at the block of two words that would end an occurrence.  The shift table says how far the nearest
window lets it move: a block that no window holds moves it past all but one word of a window.  A block
that ends windows selects the bucket of those with this end; within the bucket, sorted by the hash of
the windows' first block, those with the right beginning are found by binary search, and all their
words are compared.  Words are numbers from the exact dictionary of the windows' words, so equal
numbers are equal words, and a word no window holds is equal to nothing.  A batch of documents is cut
into segments whose cursors move at the same time, so that each step is one NumPy operation.

The windows are a stated query set against all rows.  They are dealt to blocks of a bounded number of
windows by their hash, each block compiled by the task that owns it and written to the shared folder;
tasks that search hold a batch of documents and one block after the other, so memory depends neither
on the size of the benchmark nor on that of a text, and nothing is shuffled but windows.

Defined cases: null and empty texts have no words, are not hit, and items without words are in no
document; items that share an id are one item; the words of an item with a null id are hit but it is
not listed; repeated rows are searched each; empty tables give an empty result, or no hits.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm.common import LETTERS, text_of
from palate.llm.files import Roll, read_at
from palate.session import settle, shuffle_partitions, work_path

WIDTH = 10
#: Windows in a block, about; bytes of text that are searched at a time, and of a piece split into words.
BLOCK = 200_000
BYTES_AT_ONCE = 4 << 20
PIECE = 1 << 20
#: Ends of windows that one cursor goes through, and candidates compared at a time.
SEGMENT = 256
COMPARED = 1 << 18
#: Blocks that a Python worker keeps.
KEPT_BLOCKS = 4
#: Two odd multipliers that spread pairs of numbers; and the size of a shift table.
SPREAD = (np.uint32(2654435761), np.uint32(2246822519))
TABLE_BITS = 18


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(text):
        stop = at + size
        if stop < len(text):
            near = text[at:stop].translate(LETTERS).rfind(b" ") + 1
            while not near and stop < len(text):  # a word longer than a piece
                stop += size
                near = text[at:stop].translate(LETTERS).rfind(b" ") + 1
            stop = at + near if near and stop < len(text) else stop
        yield text[at:stop].translate(LETTERS).split()
        at = stop


def windows(benchmark: DataFrame, width: int = WIDTH, item: str = "item_id", text: str = "text") -> DataFrame:
    """``window, item``: each item's different windows (words joined by spaces) and its id as a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rest: list[bytes] = []
                full = False
                for words in pieces(text):
                    words = rest + words
                    found = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
                    full = full or bool(found)
                    yield batch_of(found, name)
                    rest = words[-(width - 1) :] if width > 1 else []
                if rest and not full:
                    yield batch_of([b" ".join(rest)], name)

    def batch_of(found: list[bytes], name: str | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.repeat(pa.scalar(name, pa.string()), len(found))], ["window", "item"])

    texts = benchmark.select(F.col(item).cast("string").alias("item"), text_of(text).cast("binary").alias("text"))
    return texts.mapInArrow(run, "window binary, item string").distinct()


def _hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """32 bits of a block of two words; a block of one word gives it twice."""
    h = a.astype(np.uint32) * SPREAD[0] + b.astype(np.uint32) * SPREAD[1]
    return h ^ h >> np.uint32(15)


class Patterns:
    """Shift table and buckets for windows of one number of words, given as rows of word numbers."""

    def __init__(self, rows: np.ndarray):
        self.size = rows.shape[1]
        self.pair = min(2, self.size)  # words of a block
        self.shift = np.full(1 << TABLE_BITS, self.size - self.pair + 1, np.uint8 if self.size < 256 else np.int32)
        for end in range(self.pair - 1, self.size):  # ever smaller shifts, so the smallest of a block stays
            self.shift[self.slot(_hash(rows[:, end - self.pair + 1], rows[:, end]))] = self.size - 1 - end
        keys = self.keys(rows)
        self.order = np.argsort(keys, kind="stable")
        self.sorted, self.rows = keys[self.order], rows[self.order]

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return h & np.uint32((1 << TABLE_BITS) - 1)

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """Bucket of the last block, then the hash of the first."""
        last = _hash(rows[:, -self.pair], rows[:, -1]).astype(np.uint64)
        return last << np.uint64(32) | _hash(rows[:, 0], rows[:, self.pair - 1]).astype(np.uint64)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where an occurrence ends, and the window (by its first row number) that occurs there."""
        at = np.arange(self.size - 1, len(ids), SEGMENT)
        stop = np.minimum(at + SEGMENT, len(ids))
        ends = []
        while len(at):
            move = self.shift[self.slot(_hash(ids[at - self.pair + 1], ids[at]))]
            ends.append(at[move == 0])
            at = at + np.maximum(move, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        ends = np.concatenate(ends) if ends else at
        found = [self.compare(ids, ends[k : k + COMPARED]) for k in range(0, len(ends), COMPARED)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def compare(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(ends):
            return ends, ends
        first = ends - self.size + 1
        words = np.stack([ids[first], ids[first + self.pair - 1], ids[ends - self.pair + 1], ids[ends]], axis=1)
        key = _hash(words[:, 2], words[:, 3]).astype(np.uint64) << np.uint64(32) | _hash(words[:, 0], words[:, 1]).astype(np.uint64)
        lo, hi = np.searchsorted(self.sorted, key, "left"), np.searchsorted(self.sorted, key, "right")
        out_ends, out_windows = [], []
        while True:  # the bucket's first, second, ... window of each place that has so many
            more = np.flatnonzero(lo < hi)
            if not len(more):
                break
            row, end = lo[more], ends[more]
            same = np.ones(len(more), bool)
            for k in range(self.size):
                same &= self.rows[row, k] == ids[end - self.size + 1 + k]
            out_ends.append(end[same])
            out_windows.append(self.order[row[same]])
            lo = lo + 1
        none = np.zeros(0, np.int64)
        return np.concatenate(out_ends or [none]), np.concatenate(out_windows or [none])


class Block:
    """Compiled windows: the dictionary of their words, the patterns by size, and each window's items."""

    def __init__(self, data: bytes):
        with np.load(io.BytesIO(data)) as stored:
            words = stored["words"].tobytes().split()
            self.items = stored["items"].tobytes().decode().split("\0") if len(stored["items"]) else []
            sizes = stored["sizes"]
            self.by_size = [(Patterns(stored[f"rows{m}"]), stored[f"first{m}"], stored[f"item{m}"]) for m in sizes.tolist()]
        self.number = {w: i for i, w in enumerate(words)}

    @staticmethod
    def compiled(pairs: pd.DataFrame) -> bytes:
        """A block's bytes from its rows ``window, item``."""
        number: dict[bytes, int] = {}
        items = {x: i for i, x in enumerate(sorted(pairs["item"].dropna().unique()))}
        owners: dict[bytes, list[int]] = {}
        for window, item in zip(pairs["window"], pairs["item"], strict=True):
            mine = owners.setdefault(bytes(window), [])
            if item in items:
                mine.append(items[item])
        by_size: dict[int, list[bytes]] = {}
        for window in owners:
            by_size.setdefault(window.count(b" ") + 1, []).append(window)
        stored = {}
        for m, found in by_size.items():
            stored[f"rows{m}"] = np.array([[number.setdefault(w, len(number)) for w in x.split()] for x in found], np.int32)
            stored[f"first{m}"] = np.cumsum([0, *[len(owners[x]) for x in found]])
            stored[f"item{m}"] = np.array([i for x in found for i in owners[x]], np.int64)
        out = io.BytesIO()
        np.savez(
            out, words=np.frombuffer(b" ".join(number), np.uint8), sizes=np.array(list(by_size), np.int64),
            items=np.frombuffer("\0".join(items).encode(), np.uint8), **stored,
        )
        return out.getvalue()

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words, one -1 behind each text, and each text's number of words."""
        out, waiting, counts = [], [], []

        def settle_words() -> None:
            out.append(np.fromiter(map(self.number.get, waiting, repeat(-1)), np.int32, len(waiting)))
            waiting.clear()

        for text in texts:
            n = 0
            for words in pieces(text):
                n += len(words)
                waiting += words
                if len(waiting) > 1 << 17:
                    settle_words()
            counts.append(n)
            waiting.append(b"")  # no word
        settle_words()
        return np.concatenate(out), np.array(counts, np.int64)

    def search(self, texts: list[bytes], hit: list[np.ndarray], found: list[set[str]]) -> list[np.ndarray]:
        """Mark the words hit in each text and add the items that occur."""
        ids, counts = self.ids(texts)
        starts = np.concatenate([[0], np.cumsum(counts + 1)])
        edges = np.zeros(len(ids) + 1, np.int32)
        for patterns, first, item in self.by_size:
            ends, window = patterns.search(ids)
            np.add.at(edges, ends - patterns.size + 1, 1)
            np.add.at(edges, ends + 1, -1)
            text = np.searchsorted(starts, ends, "right") - 1
            order = np.argsort(text, kind="stable")
            text, window = text[order], window[order]
            for lo, hi in zip(*_runs(text), strict=True):
                which = np.unique(window[lo:hi])
                mine = np.unique(np.concatenate([item[first[w] : first[w + 1]] for w in which]))
                found[text[lo]].update(map(self.items.__getitem__, mine.tolist()))
        marked = np.cumsum(edges[:-1]) > 0
        parts = [marked[a : a + n] for a, n in zip(starts, counts, strict=False)]
        return [x | y for x, y in zip(hit, parts, strict=True)] if hit else parts


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal numbers begin and end."""
    edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else np.zeros(1, np.int64)
    return edges[:-1], edges[1:]


@lru_cache(maxsize=KEPT_BLOCKS)
def opened(path: str, offset: int, length: int) -> Block:
    return Block(read_at(path, offset, length))


def compile_blocks(found: DataFrame, folder: str, block: int = BLOCK) -> list[tuple[str, int, int]]:
    """Write the compiled blocks of ``window, item``; file, offset and length of each.

    The list has one entry for every ``block`` windows, so the driver never holds windows.
    """
    stored = settle(found, "windows")
    n = stored.count()
    blocks = -(-n // block)
    if not n:
        return []

    def run(key: tuple, pairs: pd.DataFrame) -> pd.DataFrame:
        data = Block.compiled(pairs)
        roll = Roll(folder, ".windows", 1)
        file, offset = roll.append(data)
        roll.close()
        return pd.DataFrame({"file": [file], "offset": [offset], "length": [len(data)]})

    # A window that many items share is dealt to as many blocks as it needs.
    dealt = stored.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    written = settle(dealt.groupBy("block").applyInPandas(run, "file string, offset long, length long"), "blocks")
    return [tuple(r) for r in written.orderBy("file", "offset").collect()]


def occurrences(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = WIDTH,
                block: int = BLOCK, text: str = "text") -> DataFrame:
    """``keep``, ``n_words``, ``spans`` and ``items`` of each document.

    ``spans`` are the stretches of words (``start``, ``stop`` beyond the last) that lie in windows of
    the benchmark's items, and ``items`` the ids, in order, of the items whose windows occur.
    """
    spark = docs.sparkSession
    blocks = compile_blocks(windows(benchmark, width), work_path(spark, "window-blocks"), block)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    names = [*keep, "n_words", "spans", "items"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def searched(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(rows).combine_chunks()
        texts = whole.column(whole.num_columns - 1).to_pylist()
        hit: list[np.ndarray] = []
        found: list[set[str]] = [set() for _ in texts]
        for where in blocks:
            hit = opened(*where).search(texts, hit, found)
        if not blocks:
            hit = [np.zeros(sum(map(len, pieces(t))), bool) for t in texts]
        spans = []
        for h in hit:
            turns = np.flatnonzero(np.diff(h.astype(np.int8), prepend=0, append=0)) if h.any() else ()
            spans.append([{"start": a, "stop": b} for a, b in zip(turns[::2], turns[1::2], strict=True)])
        new = [pa.array([len(h) for h in hit], pa.int64()), pa.array(spans, span), pa.array([sorted(x) for x in found], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([*[c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in whole.columns[:-1]], *new], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                waiting.append(batch.slice(at, 100))
                size += sum(len(x) for x in waiting[-1].column(waiting[-1].num_columns - 1).to_pylist())
                if size >= BYTES_AT_ONCE:
                    yield searched(waiting)
                    waiting, size = [], 0
        if waiting:
            yield searched(waiting)

    made = "n_words long, spans array<struct<start: long, stop: long>>, items array<string>"
    return docs.select(*keep, text_of(text).cast("binary").alias("__text")).mapInArrow(run, ", ".join([*kept, made]))


def digests(found: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(occurrences(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


OP13_SQL = r"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(list_slice(w, i, i + 9), ' ') AS g, least(len(w), 10) AS m
        FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
sizes AS (SELECT DISTINCT m FROM win),
grams AS (SELECT rid, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
          FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)),
hits AS (SELECT rid, i, grams.m, item FROM grams JOIN win ON grams.m = win.m AND grams.g = win.g),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit
            FROM (SELECT DISTINCT rid, i, m FROM hits), LATERAL (SELECT unnest(range(i, i + m)) AS p) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)"""
