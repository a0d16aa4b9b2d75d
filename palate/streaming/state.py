"""Stateful operators of the feedback stream, on Spark's arbitrary state API.

State lives in Spark's RocksDB store below the query's checkpoint, so it survives lost executors and
restarts; an operator holds one key's state at a time.  What an operator yields are changes, to be
kept as deltas (:mod:`palate.streaming.deltas`).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from palate.operators.ratings import KEYS
from palate.streaming import deltas
from palate.streaming.feedback import DELAY, SESSION_GAP_SECONDS, latest_ratings, run_available, stream_id

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """The store that the state API needs, for the queries started inside; the setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _keep(stream: DataFrame, root: str, checkpoint: str, keys: tuple[str, ...] = (), once: bool = False) -> StreamingQuery:
    def write(batch: DataFrame, number: int) -> None:
        deltas.write_delta(batch, root, stream_id(batch.sparkSession, checkpoint), number, keys)

    with rocksdb_state(stream.sparkSession):
        return run_available(stream, write, checkpoint, "update", once)


# ---------------------------------------------------------------- latest ratings


class LatestRating(StatefulProcessor):
    """The newest rating of a pair, higher on ties; yields it when it changes."""

    def __init__(self, ttl_seconds: int | None = None):
        self.ttl = ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = {} if self.ttl is None else {"ttlDurationMs": self.ttl * 1000}
        self.last = handle.getValueState("last", "timestamp LONG, rating DOUBLE", **ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        stored = self.last.get() if self.last.exists() else None
        best = before = None if stored is None else (stored[0], stored[1])
        for r in rows:
            seen = (r["timestamp"], r["rating"])
            if best is None or seen > best:
                best = seen
        if best != before:
            self.last.update(best)
            yield Row(userId=key[0], movieId=key[1], rating=best[1], timestamp=best[0])

    def close(self) -> None:
        pass


def latest_changes(feedback: DataFrame, ttl_seconds: int | None = None) -> DataFrame:
    """A stream of ``userId, movieId, rating, timestamp``: a pair's latest rating whenever it changes.

    Rows without an id, a rating or a time are left out.  The rows that a micro-batch brings for a pair
    are folded as they are read, and yield one row at most.  With ``ttl_seconds`` a pair is forgotten that long after its last change.
    """
    types = {f.name: f.dataType.simpleString() for f in feedback.schema}
    rows = feedback.select(
        *KEYS, F.col("rating").cast("double").alias("rating"), F.col("timestamp").cast("long").alias("timestamp")
    ).na.drop()
    schema = f"userId {types['userId']}, movieId {types['movieId']}, rating double, timestamp long"
    mode = "None" if ttl_seconds is None else "ProcessingTime"
    return rows.groupBy(*KEYS).transformWithState(LatestRating(ttl_seconds), schema, "Update", mode)


def keep_latest(feedback: DataFrame, root: str, checkpoint: str, ttl_seconds: int | None = None) -> StreamingQuery:
    """Maintain the latest ratings below ``root``; only pairs that change are written.

    With ``ttl_seconds`` all there is becomes one micro-batch.
    """
    return _keep(latest_changes(feedback, ttl_seconds), root, checkpoint, KEYS, ttl_seconds is not None)


def read_kept_latest(spark: SparkSession, root: str) -> DataFrame:
    """The latest ratings, by their own time: a new run that forgot a newer rating does not undo it."""
    return latest_ratings(deltas.read_all(spark, root))


# ---------------------------------------------------------------- sessions


def merged(sessions: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """``first, last, n`` with those not more than ``gap`` apart joined, in order."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(sessions):
        if out and first - out[-1][1] <= gap:
            begun, ended, so_far = out[-1]
            out[-1] = (begun, max(ended, last), so_far + n)
        else:
            out.append((first, last, n))
    return out


class Sessions(StatefulProcessor):
    """A user's open sessions; an event-time timer closes those that no event can reach any more.

    Events of one slot of ``gap`` seconds are always one session, so a batch is folded to slots as it
    is read: memory holds slots, however many events a user has.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first LONG, last LONG, n LONG")
        self.version = handle.getValueState("version", "number LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        slots: dict[int, tuple[int, int, int]] = {}
        for r in rows:
            at = r["moment"]
            first, last, n = slots.get(at // self.gap, (at, at, 0))
            slots[at // self.gap] = (min(first, at), max(last, at), n + 1)
        held = [(s[0], s[1], s[2]) for s in self.open.get()]
        yield from self.settled(key, merged([*held, *slots.values()], self.gap), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        yield from self.settled(key, [(s[0], s[1], s[2]) for s in self.open.get()], timerValues)

    def settled(self, key, sessions: list[tuple[int, int, int]], timer_values) -> Iterator[Row]:
        """Yield the sessions that are over and the whole list of those that are not, and keep the latter."""
        watermark = timer_values.getCurrentWatermarkInMs()
        ends = lambda s: (s[1] + self.gap) * 1000  # noqa: E731  an event at the very end still belongs
        over = [s for s in sessions if ends(s) < watermark]
        still = [s for s in sessions if ends(s) >= watermark]
        number = 1 + (self.version.get()[0] if self.version.exists() else 0)
        self.version.update((number,))
        if still:
            self.open.put(still)
            self.handle.registerTimer(min(map(ends, still)) + 1)
        else:
            self.open.clear()
        shown = lambda part: [Row(session_start=a, session_end=b + self.gap, n_events=n) for a, b, n in part]
        if over:
            yield Row(userId=key[0], version=number, closed=True, sessions=shown(over))
        yield Row(userId=key[0], version=number, closed=False, sessions=shown(still))

    def close(self) -> None:
        pass


def session_changes(activity: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, delay: str = DELAY) -> DataFrame:
    """A stream of ``userId, version, closed, sessions``: sessions that closed, and each list of open ones.

    A user's versions count up; only the open list of the newest is true.  Events later than the
    watermark are left out, as in any windowed aggregate of the stream.
    """
    user = activity.schema["userId"].dataType.simpleString()
    rows = activity.where(F.col("userId").isNotNull()).withWatermark("event_time", delay)
    rows = rows.select("userId", F.unix_timestamp("event_time").alias("moment"), "event_time")
    one = "struct<session_start: long, session_end: long, n_events: long>"
    schema = f"userId {user}, version long, closed boolean, sessions array<{one}>"
    return rows.groupBy("userId").transformWithState(Sessions(gap_seconds), schema, "Update", "EventTime")


def keep_sessions(
    activity: DataFrame, root: str, checkpoint: str, gap_seconds: int = SESSION_GAP_SECONDS, delay: str = DELAY
) -> StreamingQuery:
    """Maintain the sessions of a stream below ``root``."""
    return _keep(session_changes(activity, gap_seconds, delay), root, checkpoint)


def read_sessions(spark: SparkSession, root: str, open_too: bool = True) -> DataFrame:
    """``userId, session_start, session_end, n_events`` of closed sessions and, if asked, the open ones.

    Closed sessions are read as they stand; of the open lists the newest per user counts.  If several
    runs wrote here, the newest of each user's runs counts.
    """
    rows = deltas.read_all(spark, root)
    run = rows.groupBy("userId").agg(F.max("__run").alias("__run"))
    mine = rows.join(run, ["userId", "__run"])
    found = mine.where("closed").select("userId", F.inline("sessions"))
    if not open_too:
        return found
    newest = mine.where("NOT closed").groupBy("userId").agg(F.max_by("sessions", F.col("version")).alias("sessions"))
    return found.unionByName(newest.select("userId", F.inline("sessions")))
