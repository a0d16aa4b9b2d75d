"""Feedback jobs: batch forms, and the same jobs run as file streams to their end."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from palate.functions import columns as c
from palate.operators import ratings as rt
from palate.plans.registry import query, views
from palate.session import settle, work_path
from palate.sources.readers import stream_feedback
from palate.streaming import feedback as fb
from palate.streaming import state

REVIEWS_SQL = """, reviews AS (
        SELECT strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS ts_utc,
               CASE WHEN eventType = 'purchase' THEN 'user:' || userId ELSE 'mode:' || eventType END AS mode,
               movieId, CAST(CAST(floor(abs(value)) AS BIGINT) % 10 + 1 AS DOUBLE) / CAST(2 AS DOUBLE) AS rating,
               trim('  ' || eventType || ' ') AS comment
        FROM evts)"""


def reviews(t):
    """Every event as a review: purchases are signed, other events name their mode."""
    from palate.sources.sales import half_stars

    events = t.events()
    signed = F.col("eventType") == "purchase"
    return events.select(
        c.iso_utc(F.timestamp_seconds("timestamp")).alias("ts_utc"),
        F.when(signed, c.user_tag("userId")).otherwise(c.mode_tag("eventType")).alias("mode"),
        F.col("movieId").cast("int").alias("movieId"),
        half_stars("value").alias("rating"),
        F.trim(F.concat(F.lit("  "), "eventType", F.lit(" "))).alias("comment"),
    )


@query(
    "review_rows",
    views("evts") + REVIEWS_SQL
    + " SELECT ts_utc, mode, CAST(movieId AS INTEGER) AS movieId, rating, comment FROM reviews",
)
def review_rows(t):
    return reviews(t)


@query(
    "review_to_rating",
    views("purchases")
    + """ SELECT CAST(userId AS INTEGER) AS userId, CAST(movieId AS INTEGER) AS movieId, rating,
        "timestamp" FROM purchases""",
)
def review_to_rating(t):
    rows = rt.reviews_as_ratings(reviews(t))
    return rows.withColumn("rating", F.col("rating").cast("double"))


@query(
    "review_modes",
    views("evts") + REVIEWS_SQL
    + """ SELECT CASE WHEN mode LIKE 'mode:%' THEN substr(mode, 6) END AS mode_name, count(*) AS n,
        round(avg(rating), 6) AS mean FROM reviews GROUP BY 1""",
)
def review_modes(t):
    named = reviews(t).withColumn("mode_name", c.tag_mode("mode"))
    return named.groupBy("mode_name").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 6).alias("mean")
    )


LATEST_SQL = """ SELECT userId, movieId, rating, "timestamp" FROM (
        SELECT *, row_number() OVER (PARTITION BY userId, movieId
                                     ORDER BY "timestamp" DESC, rating DESC) AS rn
        FROM purchases) WHERE rn = 1"""


@query("feedback_latest", views("purchases") + LATEST_SQL)
def feedback_latest(t):
    return fb.latest_ratings(t.purchases())


def windows_sql(width: int, slide: int) -> str:
    return f""", windows AS (
        SELECT floor("timestamp" / {slide}) * {slide} - i * {slide} AS w, movieId, rating
        FROM purchases, range({width // slide}) r(i)
        WHERE "timestamp" < floor("timestamp" / {slide}) * {slide} - i * {slide} + {width}),
    popular AS (
        SELECT CAST(w AS BIGINT) AS window_start, CAST(w AS BIGINT) + {width} AS window_end,
               movieId, count(*) AS n, sum(rating) AS score
        FROM windows GROUP BY w, movieId)"""


@query("popularity_tumbling", views("purchases") + windows_sql(86400, 86400) + " SELECT * FROM popular")
def popularity_tumbling(t):
    return fb.popularity_windows(fb.with_event_time(t.purchases()), "1 day")


@query("popularity_sliding", views("purchases") + windows_sql(86400, 21600) + " SELECT * FROM popular")
def popularity_sliding(t):
    return fb.popularity_windows(fb.with_event_time(t.purchases()), "1 day", "6 hours")


SESSIONS_SQL = """, gaps AS (
        SELECT userId, "timestamp" AS moment,
               CASE WHEN "timestamp" - lag("timestamp") OVER w <= 1800 THEN 0 ELSE 1 END AS starts
        FROM evts WINDOW w AS (PARTITION BY userId ORDER BY "timestamp")),
    numbered AS (
        SELECT *, sum(starts) OVER (PARTITION BY userId ORDER BY moment
                                    ROWS UNBOUNDED PRECEDING) AS session FROM gaps),
    sessions AS (
        SELECT userId, min(moment) AS session_start, max(moment) + 1800 AS session_end, count(*) AS n_events
        FROM numbered GROUP BY userId, session)"""


@query("user_sessions", views("evts") + SESSIONS_SQL + " SELECT * FROM sessions")
def user_sessions(t):
    return fb.user_sessions(fb.with_event_time(t.events()))


def event_stream(t):
    """The event log as a file stream; the table may be one file or a folder of parts."""
    schema = t.table("events").schema
    raw = t.spark.readStream.schema(schema).parquet(f"{t.folder}/events.parquet*")
    return fb.with_event_time(t.shape_events(raw))


def purchase_stream(t):
    return t.shape_purchases(event_stream(t)).transform(fb.with_event_time)


WINDOW_KEYS = ["window_start", "window_end", "movieId"]


@query("stream_popularity", views("purchases") + windows_sql(86400, 86400) + " SELECT * FROM popular")
def stream_popularity(t):
    windows = fb.popularity_windows(purchase_stream(t), "1 day", delay="10 minutes")
    return fb.run_to_current(windows, "stream-popularity", WINDOW_KEYS)


@query("stream_sliding", views("purchases") + windows_sql(86400, 21600) + " SELECT * FROM popular")
def stream_sliding(t):
    windows = fb.popularity_windows(purchase_stream(t), "1 day", "6 hours", delay="10 minutes")
    return fb.run_to_current(windows, "stream-sliding", WINDOW_KEYS)


def delivered(t, rows, purpose, order, parts=4):
    """Rows of a table as an inbox of files that a stream finds one at a time, in two deliveries.

    Returns ``deliver(n)``, which appends the files of delivery ``n`` (0, 1) and gives the stream.
    """
    inbox = work_path(t.spark, purpose)
    quarter = F.ntile(parts).over(Window.orderBy("part"))
    # Quarters by the values of ``order``: a few hundred distinct parts are ranked, not the rows.
    cut = rows.select((order).alias("part")).distinct().withColumn("__file", quarter)
    cut = settle(cut, f"{purpose}-cut")
    placed = settle(rows.withColumn("part", order).join(cut, "part").drop("part"), f"{purpose}-rows")

    def deliver(n):
        for file in (2 * n + 1, 2 * n + 2):
            placed.where(F.col("__file") == file).drop("__file").coalesce(1).write.mode("append").parquet(inbox)
        return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)

    return deliver


@query("stream_latest_stateful", views("purchases") + LATEST_SQL)
def stream_latest_stateful(t):
    """Latest ratings from state, over four micro-batches and a restart between deliveries."""
    deliver = delivered(t, t.purchases(), "latest-inbox", F.pmod(F.xxhash64("userId", "timestamp"), F.lit(64)))
    root, checkpoint = work_path(t.spark, "latest-state"), work_path(t.spark, "latest-state-checkpoint")
    for n in (0, 1):
        state.keep_latest(deliver(n), root, checkpoint)
    return state.read_kept_latest(t.spark, root)


@query("stream_sessions_stateful", views("evts") + SESSIONS_SQL + " SELECT * FROM sessions")
def stream_sessions_stateful(t):
    """Open and closed sessions from state; files come in the order of time, with a restart between."""
    hour = F.floor(F.col("timestamp") / 3600)
    events = t.events().select("userId", "timestamp")
    deliver = delivered(t, events, "session-inbox", hour)
    root, checkpoint = work_path(t.spark, "sessions-state"), work_path(t.spark, "sessions-state-checkpoint")
    for n in (0, 1):
        state.keep_sessions(fb.with_event_time(deliver(n)), root, checkpoint)
    return state.read_sessions(t.spark, root)


@query("stream_sessions", views("evts") + SESSIONS_SQL + " SELECT * FROM sessions")
def stream_sessions(t):
    """Slots are kept up to date by the stream; sessions, the open ones too, are read from them."""
    slots = fb.activity_slots(event_stream(t), delay="10 minutes")
    return fb.sessions_of_slots(fb.run_to_current(slots, "stream-sessions", ["userId", "slot"]))


@query("stream_latest", views("purchases") + LATEST_SQL)
def stream_latest(t):
    root, checkpoint = work_path(t.spark, "latest"), work_path(t.spark, "latest-checkpoint")
    fb.maintain_latest(purchase_stream(t).drop("event_time"), root, checkpoint)
    return fb.read_latest(t.spark, root)


@query(
    "stream_dedup",
    views("purchases")
    + ' SELECT DISTINCT userId, movieId, rating, "timestamp" FROM purchases',
)
def stream_dedup(t):
    """The purchase log delivered twice: every row is a replay of itself."""
    twice = purchase_stream(t)
    twice = twice.unionByName(purchase_stream(t))
    return fb.run_to_table(fb.drop_replays(twice), "stream-dedup").drop("event_time")


@query(
    "stream_ingest",
    views("evts")
    + """, texts AS (
        SELECT CASE WHEN eventType = 'error' THEN 'nobody' ELSE userId || '.0' END AS userId,
               CASE WHEN eventType = 'signup' THEN '' ELSE ' ' || movieId END AS movieId,
               CASE WHEN eventType = 'view' THEN value
                    ELSE (CAST(floor(abs(value)) AS BIGINT) % 10 + 1) / CAST(2 AS DOUBLE) END AS rating
        FROM evts),
    judged AS (
        SELECT CASE WHEN userId = 'nobody' THEN 'bad user' WHEN movieId = '' THEN 'bad item'
               WHEN NOT (rating BETWEEN 0.5 AND 5 AND rating * 2 = floor(rating * 2)) THEN 'bad rating'
               ELSE 'ok' END AS verdict, rating
        FROM texts)
    SELECT verdict, count(*) AS n, round(sum(rating), 4) AS total FROM judged GROUP BY verdict""",
)
def stream_ingest(t):
    """Events written as careless text; usable rows and rejects land in different folders."""
    from palate.sources.sales import half_stars

    events = event_stream(t)
    kind = F.col("eventType")
    raw = events.select(
        F.when(kind == "error", "nobody").otherwise(F.concat("userId", F.lit(".0"))).alias("userId"),
        F.when(kind == "signup", "").otherwise(F.concat(F.lit(" "), "movieId")).alias("movieId"),
        F.when(kind == "view", F.col("value")).otherwise(half_stars("value")).cast("string").alias("rating"),
        F.col("timestamp").cast("string").alias("timestamp"),
    )
    good, bad, checkpoint = (work_path(t.spark, f"ingest-{n}") for n in ("good", "bad", "checkpoint"))
    fb.ingest_feedback(raw, good, bad, checkpoint)
    accepted = t.spark.read.parquet(good).select(F.lit("ok").alias("verdict"), "rating")
    rejected = t.spark.read.parquet(bad).select(F.col("problem").alias("verdict"), "rating")
    judged = accepted.unionByName(rejected)
    return judged.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("rating"), 4).alias("total")
    )


@query("stream_from_files", views("purchases") + LATEST_SQL)
def stream_from_files(t):
    """Feedback appended as files, then read back as a stream and folded."""
    from palate.sources.writers import append_feedback

    inbox = work_path(t.spark, "feedback-inbox")
    schema = t.purchases().schema
    append_feedback(t.purchases(), inbox, fmt="parquet")
    root, checkpoint = work_path(t.spark, "files"), work_path(t.spark, "files-checkpoint")
    stream = stream_feedback(t.spark, inbox, schema=schema).drop("event_time")
    fb.maintain_latest(stream, root, checkpoint)
    return fb.read_latest(t.spark, root)
