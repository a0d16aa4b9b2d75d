import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from corpus_fixtures import prose

from palate.llm import importance

BITS = ["a", "The", "tion", " ", " ", "  ", "\n", "é", "日本", "x" * 40, "42", "'", "-", "\x00", "Über", "Z", "\x7f", "ß" * 20]


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def features(text):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5, least=20):
    """``doc_id, n_features, weight, score, rank`` straight from the definition."""
    def count(texts):
        out = [0] * 10_000
        for t in texts:
            for f in features(t):
                out[zlib.crc32(f.encode()) % 10_000] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[zlib.crc32(x.encode()) % 10_000] for x in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(words_of(text)) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_slices(seed):
    r = random.Random(seed)
    raw = bytes(r.choice(b"ab c") for _ in range(5000))
    starts = np.array([r.randrange(4800) for _ in range(3000)])
    lengths = np.array([r.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 16, 24, 29, 31, 32, 33, 100, 190]) for _ in starts])
    s = importance.Slices(np.frombuffer(raw, np.uint8), starts, lengths)
    each = [s.one(i) for i in range(len(starts))]
    assert s.xxh64().tolist() == [xxhash.xxh64_intdigest(x) for x in each]
    rows = np.arange(0, len(starts), 3)
    assert s.crc32(rows).tolist() == [zlib.crc32(each[i]) for i in rows]
    other = np.array([r.randrange(len(starts)) for _ in rows])
    assert s.equal(rows, other).tolist() == [each[i] == each[j] for i, j in zip(rows, other, strict=True)]
    t = importance.Table(s, 10_000)
    mine = [raw[a : a + n] for a, n in zip(starts, lengths, strict=True)]
    by_slot = {}
    for x, slot in zip(mine, t.slot.tolist(), strict=True):
        assert by_slot.setdefault(slot, x) == x
    assert len(set(mine)) == len(by_slot) == len(t.bucket)
    assert [t.bucket[k] for k in by_slot] == [zlib.crc32(x) % 10_000 for x in by_slot.values()]
    assert t.count.tolist() == [mine.count(by_slot[k]) for k in range(len(t.count))]


def test_equal_keys_with_other_bytes_are_other_features(monkeypatch):
    monkeypatch.setattr(importance.Slices, "xxh64", lambda s: np.full(len(s.starts), 7, np.uint64))
    batch = importance.Batch([b"a b a b c", b"b c"])
    (_, table), = batch.tables(2, 10_000)
    assert sorted(table.count.tolist()) == [1, 2, 2, 2, 2, 3]  # ba; a, c, ab, bc; b


def test_parts_of_a_batch_lose_nothing(monkeypatch):
    monkeypatch.setattr(importance, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(importance, "BYTES_AT_ONCE", 60)
    texts = [prose(1, 50), "", "One", "y" * 500 + " a b " + "z" * 300, prose(2, 33)]
    want = np.zeros(10_000, int)
    for t in texts:
        for f in features(t):
            want[zlib.crc32(f.encode()) % 10_000] += 1
    have = np.zeros(10_000, int)
    for _, table in importance.Batch([t.encode() for t in texts]).tables(3, 10_000):
        have += np.bincount(table.bucket, table.count, 10_000).astype(int)
    assert (want == have).all()


def test_draw_equals_brute_force(spark):
    r = random.Random(5)
    docs = [(i, "".join(r.choice(BITS) for _ in range(r.randint(0, 200)))) for i in range(300)]
    docs += [(1000 + i, prose(i % 7, 60)) for i in range(200)]
    target = [prose(3, 40), None, "", prose(4, 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    want = brute(docs, target)
    assert sum(x[4] is not None for x in want) > 15
    assert got(importance.resample(df, bench)) == want


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    bench = spark.createDataFrame([(prose(1, 60), "q")], "text string, weight string")
    clashing = odd.withColumnsRenamed({"kept": "weight", "size": "score", "fp": "n_words"})
    assert got(importance.resample(clashing, bench, percent=50)) == brute(rows, [prose(1, 60)], percent=50)


def test_equal_rows_get_different_ranks(spark):
    df = spark.createDataFrame([(None, prose(1, 30))] * 40 + [(3, prose(1, 30))] * 10, "doc_id long, text string")
    out = importance.resample(df, df.select("text"), percent=60).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 31))


def test_empty(spark, none):
    assert importance.resample(none, none).collect() == []
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [r["n_features"] for r in importance.resample(some, none).collect()] == [6]
