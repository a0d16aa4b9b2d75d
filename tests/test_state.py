"""Stateful streams and delta tables: restarts, new checkpoints, forgetting, late events, folding."""

import random

import pytest

from palate.sources import readers
from palate.sources.writers import append_feedback
from palate.streaming import deltas, state
from palate.streaming import feedback as fb

SCHEMA = "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT"
T0 = 20_000 * 86_400


def put(spark, inbox, rows):
    append_feedback(spark.createDataFrame(rows, SCHEMA).coalesce(1), inbox, fmt="parquet")


def stream(spark, inbox, per_batch=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    if per_batch is None:
        return readers.stream_feedback(spark, inbox, schema=schema)
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(inbox)
    return fb.with_event_time(raw)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def dirs(tmp_path):
    return lambda name: str(tmp_path / name)


def test_latest_survives_a_restart_and_yields_only_changes(spark, dirs):
    inbox, root, ckpt = dirs("in"), dirs("out"), dirs("ckpt")
    r = random.Random(1)
    sent = []
    for _ in range(2):
        for _ in range(2):
            part = [(r.randint(1, 4), r.randint(1, 3), r.randint(1, 10) / 2, T0 + r.randint(0, 20)) for _ in range(30)]
            sent += part
            put(spark, inbox, part)
        state.keep_latest(stream(spark, inbox, 1), root, ckpt)
    assert rows(state.read_kept_latest(spark, root)) == rows(fb.latest_ratings(spark.createDataFrame(sent, SCHEMA)))
    before = deltas.read_all(spark, root).count()
    put(spark, inbox, [(1, 1, 0.5, T0 - 5), (2, 2, 1.0, T0 - 9)])  # older than what is known
    state.keep_latest(stream(spark, inbox, 1), root, ckpt)
    assert deltas.read_all(spark, root).count() == before
    assert rows(state.read_kept_latest(spark, root)) == rows(fb.latest_ratings(spark.createDataFrame(sent, SCHEMA)))


def test_incomplete_rows_have_no_state(spark, dirs):
    put(spark, dirs("in"), [(None, 1, 3.0, T0), (1, None, 3.0, T0), (1, 1, None, T0), (1, 1, 3.0, None), (1, 1, 2.0, T0)])
    state.keep_latest(stream(spark, dirs("in")), dirs("out"), dirs("ckpt"))
    assert rows(state.read_kept_latest(spark, dirs("out"))) == [(1, 1, 2.0, T0)]


def test_a_pair_is_forgotten_after_its_time_to_live(spark, dirs):
    """A forgotten pair yields an older rating anew; the reader still goes by the ratings' own time."""
    import time

    inbox, root, ckpt = dirs("in"), dirs("out"), dirs("ckpt")
    put(spark, inbox, [(1, 1, 3.0, T0 + 5)])
    state.keep_latest(stream(spark, inbox), root, ckpt, ttl_seconds=1)
    time.sleep(1.5)
    put(spark, inbox, [(1, 1, 4.0, T0)])
    state.keep_latest(stream(spark, inbox), root, ckpt, ttl_seconds=1)
    assert deltas.read_all(spark, root).count() == 2
    assert rows(state.read_kept_latest(spark, root)) == [(1, 1, 3.0, T0 + 5)]


def test_the_store_setting_is_put_back(spark):
    before = spark.conf.get(state.PROVIDER, None)
    with state.rocksdb_state(spark):
        assert spark.conf.get(state.PROVIDER) == state.ROCKSDB
    assert spark.conf.get(state.PROVIDER, None) == before


# ---------------------------------------------------------------- sessions


def test_merged():
    assert state.merged([], 10) == []
    assert state.merged([(30, 40, 2), (0, 10, 1), (20, 20, 1), (51, 60, 4)], 10) == [(0, 40, 4), (51, 60, 4)]
    assert state.merged([(0, 100, 5), (3, 4, 1)], 1) == [(0, 100, 6)]


def test_sessions_close_by_timer_and_stay_open_over_restarts(spark, dirs):
    inbox, root, ckpt = dirs("in"), dirs("out"), dirs("ckpt")
    r = random.Random(3)
    sent = []
    for day in range(4):
        part = [(r.choice([1, 1, 1, 2, 3]), 1, 1.0, T0 + day * 86_400 + r.randint(0, 20) * 1500) for _ in range(60)]
        sent += part
        put(spark, inbox, part)
        if day % 2:
            state.keep_sessions(stream(spark, inbox, 1), root, ckpt)
    want = rows(fb.user_sessions(fb.with_event_time(spark.createDataFrame(sent, SCHEMA))))
    assert rows(state.read_sessions(spark, root)) == want
    closed = rows(state.read_sessions(spark, root, open_too=False))
    latest = max(x[3] for x in sent) - 600  # the watermark
    assert closed == [w for w in want if w[2] < latest] and len(closed) > 20
    assert any(not c for (c,) in rows(deltas.read_all(spark, root).select("closed")))


def test_a_late_event_joins_two_open_sessions_and_a_later_one_is_left_out(spark, dirs):
    inbox, root, ckpt = dirs("in"), dirs("out"), dirs("ckpt")
    gap = 100
    for part in (
        [(1, 1, 1.0, T0), (1, 1, 1.0, T0 + 180)],  # two sessions, both open
        [(1, 1, 1.0, T0 + 90)],  # between them, within the delay
        [(2, 1, 1.0, T0 + 5000)],  # moves the watermark on
        [(1, 1, 1.0, T0 + 5)],  # behind it
        [(1, 1, 1.0, T0 + 4950)],
    ):
        put(spark, inbox, part)
        state.keep_sessions(stream(spark, inbox, 1), root, ckpt, gap_seconds=gap, delay="200 seconds")
    assert rows(state.read_sessions(spark, root)) == [(1, T0, T0 + 280, 3), (1, T0 + 4950, T0 + 5050, 1), (2, T0 + 5000, T0 + 5100, 1)]
    assert rows(state.read_sessions(spark, root, open_too=False)) == [(1, T0, T0 + 280, 3)]


def test_a_busy_user_is_held_as_slots(spark):
    """Folding is by slot: the state machine sees thousands of events and keeps what sessions need."""
    from types import SimpleNamespace

    class Held:
        def __init__(self, value):
            self.value = value

        def get(self):
            return self.value

        def exists(self):
            return self.value is not None

        def put(self, value):
            self.value = value

        update = put

        def clear(self):
            self.value = []

    p = state.Sessions(60)
    timers = []
    p.open, p.version = Held([]), Held(None)
    p.handle = SimpleNamespace(registerTimer=timers.append)
    moments = ({"moment": T0 + i % 5000} for i in range(50_000))
    got = list(p.handleInputRows((7,), moments, SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)))
    assert [(r.closed, [tuple(s) for s in r.sessions]) for r in got] == [(False, [(T0, T0 + 4999 + 60, 50_000)])]
    assert p.open.value == [(T0, T0 + 4999, 50_000)] and timers == [(T0 + 4999 + 60) * 1000 + 1]


# ---------------------------------------------------------------- delta tables


def delta(spark, items):
    return spark.createDataFrame(items, "k INT, n INT")


def test_a_new_run_is_newer_than_any_batch_of_an_old_one(spark, dirs):
    root = dirs("t")
    deltas.write_delta(delta(spark, [(1, 10), (2, 20)]), root, "old", 3)
    deltas.write_delta(delta(spark, [(1, 99)]), root, "new", 0)
    assert rows(deltas.read_newest(spark, root, ["k"])) == [(1, 99), (2, 20)]
    deltas.write_delta(delta(spark, [(1, 11), (3, 30)]), root, "old", 4)  # an old run that goes on stays old
    assert rows(deltas.read_newest(spark, root, ["k"])) == [(1, 99), (2, 20), (3, 30)]


def test_a_repeated_batch_overwrites_itself(spark, dirs):
    for n in (1, 2):
        deltas.write_delta(delta(spark, [(1, n)]), dirs("t"), "run", 0)
    assert rows(deltas.read_newest(spark, dirs("t"), ["k"])) == [(1, 2)]
    assert deltas.read_all(spark, dirs("t")).count() == 1


def test_folding_bounds_the_files_and_keeps_the_order(spark, dirs):
    from pathlib import Path

    root, want = dirs("t"), {}
    for run, batches in (("a", 7), ("b", 6)):
        for b in range(batches):
            part = {b % 3: b, 10 + b: b * (1 if run == "a" else 100)}
            want |= part
            deltas.write_delta(delta(spark, list(part.items())), root, run, b, ["k"], most=3)
            assert rows(deltas.read_newest(spark, root, ["k"])) == sorted(want.items())
    generations = sorted(p.name for p in Path(root).glob("generation=*"))
    assert len(generations) <= 2 and deltas._generation(spark, root) == 4
    assert len(list(Path(root).rglob("batch=*"))) <= 2 * 3
    deltas.write_delta(delta(spark, [(0, -1)]), root, "a", 99, ["k"], most=3)  # the older run, after folding
    assert rows(deltas.read_newest(spark, root, ["k"])) == sorted(want.items())


def test_a_base_that_was_not_finished_does_not_count(spark, dirs):
    from pathlib import Path

    root = dirs("t")
    deltas.write_delta(delta(spark, [(1, 1)]), root, "run", 0)
    (Path(root) / "generation=1" / "base").mkdir(parents=True)
    deltas.write_delta(delta(spark, [(2, 2)]), root, "run", 1)
    assert rows(deltas.read_newest(spark, root, ["k"])) == [(1, 1), (2, 2)]
    deltas.fold(spark, root, ["k"])
    assert deltas._generation(spark, root) == 1 and rows(deltas.read_newest(spark, root, ["k"])) == [(1, 1), (2, 2)]


def test_nothing_written(spark, dirs):
    with pytest.raises(ValueError, match="nothing was written"):
        deltas.read_newest(spark, dirs("none"), ["k"])


def test_windows_of_two_checkpoints_over_one_root(spark, dirs):
    inbox, root = dirs("in"), dirs("windows")
    keys = ["window_start", "window_end", "movieId"]
    for n in range(3):
        put(spark, inbox, [(n, 1, 4.0, T0 + 60 * n)])
        fb.keep_updates(fb.popularity_windows(stream(spark, inbox)), root, dirs("first"), keys, most=2)
    put(spark, inbox, [(9, 1, 1.0, T0 + 500), (9, 2, 1.0, T0 + 500)])
    fb.keep_updates(fb.popularity_windows(stream(spark, inbox)), root, dirs("second"), keys, most=2)
    got = fb.read_updates(spark, root, keys).select("movieId", "n")
    assert rows(got) == [(1, 4), (2, 1)]
