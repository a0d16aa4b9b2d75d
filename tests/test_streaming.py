"""Streams: late and replayed feedback, restarts, and equality with the batch form."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from palate.sources import readers
from palate.sources.writers import append_feedback
from palate.streaming import feedback as fb

SCHEMA = "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT"
DAY = 86_400
T0 = 20_000 * DAY


def put(spark, inbox, rows):
    append_feedback(spark.createDataFrame(rows, SCHEMA).coalesce(1), inbox, fmt="parquet")


def stream(spark, inbox):
    schema = spark.createDataFrame([], SCHEMA).schema
    return readers.stream_feedback(spark, inbox, schema=schema)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def dirs(tmp_path):
    return lambda name: str(tmp_path / name)


def test_latest_is_maintained_over_runs(spark, dirs):
    inbox, root, ckpt = dirs("in"), dirs("latest"), dirs("ckpt")
    first = [(1, 1, 3.0, T0), (1, 1, 4.0, T0 + 5), (2, 1, 2.0, T0)]
    second = [(1, 1, 5.0, T0 + 1), (2, 1, 4.5, T0 + 9), (3, 9, 1.0, T0)]
    put(spark, inbox, first)
    fb.maintain_latest(stream(spark, inbox).drop("event_time"), root, ckpt)
    put(spark, inbox, second)
    fb.maintain_latest(stream(spark, inbox).drop("event_time"), root, ckpt)
    fb.maintain_latest(stream(spark, inbox).drop("event_time"), root, ckpt)  # nothing new
    want = rows(fb.latest_ratings(spark.createDataFrame(first + second, SCHEMA)))
    assert rows(fb.read_latest(spark, root)) == want
    assert (1, 1, 4.0, T0 + 5) in want
    fb.compact_latest(spark, root, dirs("compact"))
    assert rows(fb.read_latest(spark, dirs("compact"))) == want
    with pytest.raises(ValueError):
        fb.compact_latest(spark, root, dirs("compact"))


def test_a_repeated_batch_does_not_double(spark, dirs, monkeypatch):
    monkeypatch.setattr(fb, "stream_id", lambda spark, checkpoint: "one")
    write = fb._batch_writer({dirs("out"): lambda b: b}, dirs("ckpt"))
    batch = spark.createDataFrame([(1, 1, 3.0, T0)], SCHEMA)
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(dirs("out")).count() == 1


def test_a_new_checkpoint_overwrites_no_delta(spark, dirs):
    first, second = [(1, 1, 3.0, T0), (2, 1, 2.0, T0)], [(3, 9, 1.0, T0)]
    put(spark, dirs("in"), first)
    fb.maintain_latest(stream(spark, dirs("in")).drop("event_time"), dirs("latest"), dirs("ckpt"))
    fb.compact_latest(spark, dirs("latest"), dirs("compact"))
    put(spark, dirs("more"), second)
    for root in ("latest", "compact"):
        later = stream(spark, dirs("more")).drop("event_time")
        fb.maintain_latest(later, dirs(root), dirs(f"ckpt-{root}"))
        assert rows(fb.read_latest(spark, dirs(root))) == sorted(first + second)


STREAMS = ["stream_popularity", "stream_sliding", "stream_sessions", "stream_latest", "stream_dedup", "stream_ingest"]


@pytest.mark.parametrize("name", STREAMS)
def test_a_table_may_be_a_folder_of_parts(spark, dirs, name):
    from palate.plans.registry import QUERIES

    source = "/root/testdata/sf0.001/events.parquet"
    spark.read.parquet(source).repartition(3).write.parquet(f"{dirs('tables')}/events.parquet")
    assert rows(QUERIES[name](spark, dirs("tables"))) == rows(QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_replays_are_dropped(spark, dirs):
    inbox = dirs("in")
    put(spark, inbox, [(1, 1, 3.0, T0), (1, 1, 3.0, T0), (1, 1, 2.5, T0 + 5)])
    out, ckpt = dirs("out"), dirs("ckpt")
    fb.append_stream(fb.drop_replays(stream(spark, inbox)), out, ckpt)
    put(spark, inbox, [(1, 1, 3.0, T0), (2, 2, 4.0, T0 + 30)])
    fb.append_stream(fb.drop_replays(stream(spark, inbox)), out, ckpt)
    got = spark.read.parquet(out).select("userId", "movieId", "rating")
    assert rows(got) == [(1, 1, 2.5), (1, 1, 3.0), (2, 2, 4.0)]


def test_late_rows_miss_closed_windows_only(spark, dirs):
    inbox, out, ckpt = dirs("in"), dirs("out"), dirs("ckpt")

    def run():
        windows = fb.popularity_windows(stream(spark, inbox), "1 day", delay="1 hour")
        fb.append_stream(windows, out, ckpt)

    put(spark, inbox, [(1, 7, 4.0, T0 + 10), (2, 7, 2.0, T0 + 20)])
    run()
    put(spark, inbox, [(3, 7, 5.0, T0 + 30), (4, 8, 1.0, T0 + DAY + 100)])  # late, window still open
    run()
    put(spark, inbox, [(5, 8, 3.0, T0 + 3 * DAY)])  # closes the first two days
    run()
    put(spark, inbox, [(6, 7, 5.0, T0 + 40), (7, 8, 1.0, T0 + 6 * DAY)])  # too late; closes day 4
    run()
    got = {(r["window_start"], r["movieId"]): (r["n"], r["score"]) for r in spark.read.parquet(out).collect()}
    assert got == {(T0, 7): (3, 11.0), (T0 + DAY, 8): (1, 1.0), (T0 + 3 * DAY, 8): (1, 3.0)}


def test_sliding_windows_overlap(spark):
    df = fb.with_event_time(spark.createDataFrame([(1, 7, 4.0, T0 + 7 * 3600)], SCHEMA))
    starts = [r["window_start"] for r in fb.popularity_windows(df, "1 day", "6 hours").collect()]
    assert sorted(starts) == [T0 + h * 3600 for h in (-12, -6, 0, 6)]


def test_sessions_batch_equals_stream(spark, dirs):
    inbox = dirs("in")
    moments = [0, 100, 1900, 3701, 3701 + 1800, 3701 + 3601, 20_000, 90_000]
    data = [(u, 1, 3.0, T0 + m * (1 if u == 1 else 2)) for u in (1, 2) for m in moments]
    put(spark, inbox, data)
    batch = fb.user_sessions(fb.with_event_time(spark.createDataFrame(data, SCHEMA)))
    out = dirs("out")
    fb.append_stream(fb.user_sessions(stream(spark, inbox), delay="1 second"), out, dirs("ckpt"))
    newest = max(r[3] for r in data)
    closed = batch.where(F.col("session_end") <= newest - 1)
    columns = ["userId", "session_start", "session_end", "n_events"]
    assert rows(spark.read.parquet(out).select(*columns)) == rows(closed.select(*columns))
    first = [r for r in rows(batch.select(*columns)) if r[0] == 1][0]
    assert first == (1, T0, T0 + 1900 + 1800, 3)


def test_ingest_separates_good_and_bad(spark, dirs):
    inbox = Path(dirs("in"))
    inbox.mkdir()
    (inbox / "a.csv").write_text(
        "userId,movieId,rating,timestamp\n 1 ,2.0,4.5,1758027399\nabc,2,3.0,1\n3,,3.0,1\n4,5,3.3,1\n4,5,7.0,1\n6,7,1.0,\n"
    )
    raw = spark.readStream.schema("userId STRING, movieId STRING, rating STRING, timestamp STRING").option(
        "header", True
    ).csv(str(inbox))
    fb.ingest_feedback(raw, dirs("good"), dirs("bad"), dirs("ckpt"))
    good = spark.read.parquet(dirs("good"))
    assert [tuple(r)[:4] for r in good.collect()] == [(1, 2, 4.5, 1758027399, 0)[:4]]
    problems = [r["problem"] for r in spark.read.parquet(dirs("bad")).collect()]
    assert sorted(problems) == ["bad item", "bad rating", "bad rating", "bad time", "bad user"]
