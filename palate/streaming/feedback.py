"""Structured Streaming over feedback, and the batch form of every aggregate.

An aggregate is one function for static and streaming frames alike; only the watermark and the
sink differ.  Event time is the column ``event_time`` (TIMESTAMP).
"""

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palate.functions.columns import lenient_id, on_rating_scale
from palate.operators.ranking import rounded
from palate.operators.ratings import KEYS
from palate.session import work_path
from palate.sources.readers import path_exists
from palate.streaming import deltas

DELAY = "10 minutes"
SESSION_GAP_SECONDS = 1800


def with_event_time(feedback: DataFrame) -> DataFrame:
    return feedback.withColumn("event_time", F.timestamp_seconds("timestamp"))


# ---------------------------------------------------------------- intake


def coerce_feedback(raw: DataFrame) -> DataFrame:
    """Untyped text columns to feedback, plus ``problem`` (null when the row is usable)."""
    typed = raw.select(
        lenient_id("userId").alias("userId"),
        lenient_id("movieId").alias("movieId"),
        F.trim("rating").try_cast("double").alias("rating"),
        lenient_id("timestamp", "bigint").alias("timestamp"),
        *[c for c in raw.columns if c not in (*KEYS, "rating", "timestamp")],
    )
    problem = (
        F.when(F.col("userId").isNull(), "bad user")
        .when(F.col("movieId").isNull(), "bad item")
        .when(~on_rating_scale("rating"), "bad rating")
        .when(F.col("timestamp").isNull(), "bad time")
    )
    return typed.withColumn("problem", problem)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: the same after a restart, another for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _batch_writer(targets: dict[str, Callable[[DataFrame], DataFrame]], checkpoint: str):
    """``foreachBatch`` body that writes parts of a batch to folders named by stream and batch.

    A batch that is run again after a failure overwrites its own folder, so nothing doubles; a
    stream with a new checkpoint counts its batches from 0 again, in folders of its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = stream_id(batch.sparkSession, checkpoint)
        batch.persist()
        try:
            for path, part in targets.items():
                part(batch).write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def run_available(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", once: bool = False
) -> StreamingQuery:
    """Process everything there is, then stop.  ``checkpoint`` must outlive the executors.

    State that expires by the clock always asks for another batch, so such a stream must run as a
    single one (``once``).
    """
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"once": True} if once else {"availableNow": True}))
        .start()
    )
    query.awaitTermination()
    return query


def ingest_feedback(raw: DataFrame, accepted: str, quarantined: str, checkpoint: str) -> StreamingQuery:
    """Coerce and validate a raw text stream; good rows and bad rows go to different folders."""
    checked = coerce_feedback(raw)
    usable = F.col("problem").isNull()
    targets = {
        accepted: lambda batch: batch.where(usable).drop("problem"),
        quarantined: lambda batch: batch.where(~usable),
    }
    return run_available(checked, _batch_writer(targets, checkpoint), checkpoint)


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet with the exactly-once file sink."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drop_replays(feedback: DataFrame, delay: str = DELAY) -> DataFrame:
    """Drop repeats of the same event that arrive within ``delay`` of it."""
    identity = [*KEYS, "rating", "timestamp"]
    if not feedback.isStreaming:
        return feedback.dropDuplicates(identity)
    return feedback.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(identity)


# ---------------------------------------------------------------- latest ratings


def latest_ratings(feedback: DataFrame) -> DataFrame:
    """``userId, movieId, rating, timestamp`` of the newest rating per pair, higher on ties."""
    newest = F.max_by(F.struct("rating", "timestamp"), F.struct("timestamp", "rating"))
    return feedback.groupBy(*KEYS).agg(newest.alias("last")).select(*KEYS, "last.rating", "last.timestamp")


def maintain_latest(feedback: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Fold each micro-batch to its latest rows and store them as one delta.

    A batch costs what it brings, not what was stored before; :func:`read_latest` merges deltas
    and :func:`compact_latest` folds them into one.
    """
    return run_available(feedback, _batch_writer({root: latest_ratings}, checkpoint), checkpoint)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    return latest_ratings(spark.read.parquet(root).drop("run", "batch"))


def compact_latest(spark: SparkSession, root: str, out: str) -> None:
    """Write the merged deltas to a new folder, which readers and streams then use in place of ``root``.

    The base has a name that no stream takes.
    """
    if path_exists(spark, out):
        raise ValueError(f"{out} exists; compaction writes a new folder")
    read_latest(spark, root).write.parquet(f"{out}/run=base-{uuid.uuid4().hex}/batch=0")


# ---------------------------------------------------------------- windows and sessions


def _watermarked(feedback: DataFrame, delay: str) -> DataFrame:
    return feedback.withWatermark("event_time", delay) if feedback.isStreaming else feedback


def _seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def popularity_windows(
    feedback: DataFrame, width: str = "1 day", slide: str | None = None, delay: str = DELAY
) -> DataFrame:
    """``window_start, window_end`` (epoch seconds), ``movieId, n, score`` with score = n x mean.

    Tumbling without ``slide``, sliding with it.  A popular item is folded map-side.
    """
    window = F.window("event_time", width, slide) if slide else F.window("event_time", width)
    counted = (
        _watermarked(feedback, delay)
        .groupBy(window.alias("window"), "movieId")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("rating").cast("double")).alias("total"))
    )
    return counted.select(
        _seconds(F.col("window.start")).alias("window_start"),
        _seconds(F.col("window.end")).alias("window_end"),
        "movieId",
        "n",
        rounded(F.col("total")).alias("score"),
    )


def user_sessions(
    activity: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, delay: str = DELAY
) -> DataFrame:
    """``userId, session_start, session_end, n_events``; a session ends ``gap`` after its last event.

    A stream uses Spark's session windows.  A static table is first folded to slots of one gap
    (events of a slot are always one session), so a user with a third of all events
    costs as many rows as there are slots in the calendar.
    """
    if activity.isStreaming:
        session = F.session_window("event_time", f"{gap_seconds} seconds").alias("session")
        counted = _watermarked(activity, delay).groupBy(session, "userId")
        return counted.agg(F.count(F.lit(1)).alias("n_events")).select(
            "userId",
            _seconds(F.col("session.start")).alias("session_start"),
            _seconds(F.col("session.end")).alias("session_end"),
            "n_events",
        )
    return sessions_of_slots(activity_slots(activity, gap_seconds), gap_seconds)


def activity_slots(activity: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, delay: str = DELAY) -> DataFrame:
    """``userId, slot, first, last, n``: activity folded to slots of one gap, static or streaming."""
    at = _seconds(F.col("event_time"))
    slot = F.window("event_time", f"{gap_seconds} seconds")
    folded = _watermarked(activity, delay).groupBy(slot.alias("window"), "userId").agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n")
    )
    number = F.floor(_seconds(F.col("window.start")) / gap_seconds)
    return folded.select("userId", number.alias("slot"), "first", "last", "n")


def sessions_of_slots(slots: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Sessions, open ones too, from :func:`activity_slots`."""
    by_user = Window.partitionBy("userId").orderBy("slot")
    starts = F.col("first") - F.lag("last").over(by_user) > gap_seconds
    flagged = slots.withColumn("starts", F.coalesce(starts, F.lit(True)).cast("int"))
    numbered = flagged.withColumn("session", F.sum("starts").over(by_user))
    return (
        numbered.groupBy("userId", "session")
        .agg(
            F.min("first").alias("session_start"),
            (F.max("last") + gap_seconds).alias("session_end"),
            F.sum("n").alias("n_events"),
        )
        .drop("session")
    )


# ---------------------------------------------------------------- streams run to their end


def run_to_table(stream: DataFrame, purpose: str) -> DataFrame:
    """Run an append-mode stream over everything available and return what it wrote."""
    spark = stream.sparkSession
    out, checkpoint = work_path(spark, purpose), work_path(spark, f"{purpose}-checkpoint")
    append_stream(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


def keep_updates(
    stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str] = (), most: int = deltas.MOST
) -> StreamingQuery:
    """Store each batch's changed rows of an aggregate; :func:`read_updates` gives the current table.

    With ``keys`` the stored rows are folded after ``most`` batches, so that small files stay few.
    """

    def write(batch: DataFrame, number: int) -> None:
        deltas.write_delta(batch, root, stream_id(batch.sparkSession, checkpoint), number, keys, most)

    return run_available(stream, write, checkpoint, "update")


def read_updates(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key by run and batch, windows that are still open included."""
    return deltas.read_newest(spark, root, keys)


def run_to_current(stream: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    """Run an aggregate over everything available and return its current table."""
    spark = stream.sparkSession
    out, checkpoint = work_path(spark, purpose), work_path(spark, f"{purpose}-checkpoint")
    keep_updates(stream, out, checkpoint, keys)
    return read_updates(spark, out, keys).select(stream.columns)
