"""Rating views, per-item facts and popularity lists."""

from pyspark.sql import functions as F

from palate.functions.columns import lenient_id, on_rating_scale
from palate.operators import catalog, popularity, ratings as rt
from palate.operators.ranking import rounded
from palate.plans.registry import query, views

#: Supports in the small tables stay below the library default of 50.
MIN_COUNT = 20
TOP = 50


@query(
    "ratings_view",
    views("ratings") + 'SELECT userId, movieId, rating, "timestamp" FROM ratings',
)
def ratings_view(t):
    return t.ratings()


@query("ratings_summed", views("entries") + "SELECT userId, movieId, rating FROM entries")
def ratings_summed(t):
    return rt.resolve_duplicates(t.ratings(), "sum")


@query(
    "ratings_latest",
    views("ratings")
    + """SELECT userId, movieId, rating FROM (
        SELECT *, row_number() OVER (PARTITION BY userId, movieId
                                     ORDER BY "timestamp" DESC, rating DESC) AS rn
        FROM ratings) WHERE rn = 1""",
)
def ratings_latest(t):
    return rt.resolve_duplicates(t.ratings(), "latest")


@query(
    "ratings_avg",
    views("ratings")
    + "SELECT userId, movieId, round(avg(rating), 6) AS rating FROM ratings GROUP BY userId, movieId",
)
def ratings_avg(t):
    return rt.resolve_duplicates(t.ratings(), "avg").withColumn("rating", rounded(F.col("rating")))


@query(
    "item_stats",
    views("stats") + "SELECT movieId, n, total, round(mean, 6) AS mean FROM stats",
)
def item_stats(t):
    return rt.item_stats(t.ratings()).withColumn("mean", rounded(F.col("mean")))


@query(
    "weighted_popularity",
    views("stats", "movies")
    + f""", scored AS (
        SELECT movieId, n, round(mean, 6) AS mean,
               round((n / (n + CAST(50 AS DOUBLE))) * mean
                     + (CAST(50 AS DOUBLE) / (n + CAST(50 AS DOUBLE)))
                       * (SELECT avg(rating) FROM ratings), 6) AS wr
        FROM stats),
    best AS (
        SELECT *, CAST(row_number() OVER (ORDER BY wr DESC, n DESC, movieId) AS INTEGER) AS rank
        FROM scored)
    SELECT movieId, n, mean, wr, rank, title FROM best LEFT JOIN movies USING (movieId)
    WHERE rank <= {TOP}""",
)
def weighted_popularity(t):
    best = popularity.weighted_popularity(t.ratings(), m=50, k=TOP)
    return catalog.with_titles(best, t.movies(), size_bound=TOP)


@query(
    "popular_supported",
    views("stats", "movies")
    + f""", best AS (
        SELECT movieId, n, round(mean, 6) AS mean,
               CAST(row_number() OVER (ORDER BY round(mean, 6) DESC, n DESC, movieId) AS INTEGER) AS rank
        FROM stats WHERE n >= {MIN_COUNT})
    SELECT movieId, n, mean, rank, title FROM best JOIN movies USING (movieId)
    WHERE rank <= {TOP}""",
)
def popular_supported(t):
    best = popularity.popular_supported(t.ratings(), min_count=MIN_COUNT, k=TOP)
    return catalog.only_titled(best, t.movies())


@query(
    "popular_mean_count",
    views("stats", "movies")
    + f""", best AS (
        SELECT movieId, round(mean, 6) AS score, n,
               CAST(row_number() OVER (ORDER BY round(mean, 6) DESC, n DESC, movieId) AS INTEGER) AS rank
        FROM stats)
    SELECT movieId, score, n, rank, title FROM best LEFT JOIN movies USING (movieId)
    WHERE rank <= {TOP}""",
)
def popular_mean_count(t):
    best = popularity.popular_mean_count(t.ratings(), k=TOP)
    return catalog.with_titles(best, t.movies(), size_bound=TOP)


@query(
    "popular_count_mean",
    views("stats", "movies")
    + f""", best AS (
        SELECT movieId, n, round(n * mean, 6) AS score,
               CAST(row_number() OVER (ORDER BY round(n * mean, 6) DESC, movieId) AS INTEGER) AS rank
        FROM stats)
    SELECT movieId, n, score, rank, title FROM best LEFT JOIN movies USING (movieId)
    WHERE rank <= {TOP}""",
)
def popular_count_mean(t):
    best = popularity.popular_count_mean(t.ratings(), k=TOP)
    return catalog.with_titles(best, t.movies(), size_bound=TOP)


@query(
    "popular_by_genre",
    views("stats", "movies")
    + """, genres AS (
        SELECT DISTINCT movieId, unnest(string_split(genres, '|')) AS genre FROM movies),
    scored AS (
        SELECT genre, movieId, n,
               round((n / (n + CAST(50 AS DOUBLE))) * mean
                     + (CAST(50 AS DOUBLE) / (n + CAST(50 AS DOUBLE)))
                       * (SELECT avg(rating) FROM ratings), 6) AS wr
        FROM stats JOIN genres USING (movieId)),
    best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY genre ORDER BY wr DESC, n DESC, movieId)
                       AS INTEGER) AS rank
        FROM scored)
    SELECT genre, movieId, n, wr, rank FROM best WHERE rank <= 5""",
)
def popular_by_genre(t):
    return popularity.popular_by_genre(t.ratings(), t.movies(), m=50, k=5)


@query(
    "exclude_popular",
    views("stats")
    + f""", kept AS (
        SELECT movieId, n, round(mean, 6) AS mean FROM stats
        WHERE n <= (SELECT quantile_cont(n, 0.95) FROM stats) AND n >= {MIN_COUNT}),
    best AS (
        SELECT *, CAST(row_number() OVER (ORDER BY mean DESC, n DESC, movieId) AS INTEGER) AS rank
        FROM kept)
    SELECT movieId, n, mean, rank FROM best WHERE rank <= {TOP}""",
)
def exclude_popular(t):
    kept = popularity.exclude_popular(t.ratings(), t.ratings(), top_share=0.05)
    return popularity.popular_supported(kept, min_count=MIN_COUNT, k=TOP)


@query(
    "item_norms",
    views("norms") + "SELECT movieId, round(norm, 6) AS norm, raters FROM norms",
)
def item_norms(t):
    norms = rt.item_norms(rt.resolve_duplicates(t.ratings()))
    return norms.withColumn("norm", rounded(F.col("norm")))


@query(
    "genre_explode",
    views("movies")
    + """, split AS (
        SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM movies)
    SELECT genre, count(*) AS n_items, min(movieId) AS first_item FROM split GROUP BY genre""",
)
def genre_explode(t):
    split = catalog.explode_genres(t.movies())
    return split.groupBy("genre").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("movieId").alias("first_item")
    )


@query(
    "known_users",
    views("ratings") + "SELECT DISTINCT userId FROM ratings ORDER BY userId",
)
def known_users(t):
    return rt.known_users(t.ratings())


@query("first_titles", views("movies") + "SELECT movieId, title FROM movies ORDER BY movieId LIMIT 5000")
def first_titles(t):
    return catalog.first_titles(t.movies(), 5000)


@query(
    "recent_ratings",
    views("ratings", "movies")
    + """, latest AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY userId
            ORDER BY "timestamp" DESC, rating DESC, movieId) AS INTEGER) AS recency
        FROM ratings)
    SELECT userId, movieId, title, rating, "timestamp", recency
    FROM latest LEFT JOIN movies USING (movieId) WHERE recency <= 25""",
)
def recent_ratings(t):
    return catalog.recent_ratings(t.ratings(), t.movies(), n=25)


@query(
    "title_lookup",
    views("movies")
    + """, asked AS (
        SELECT DISTINCT title FROM movies
        UNION ALL SELECT DISTINCT 'no ' || title FROM movies),
    known AS (SELECT title, min(movieId) AS movieId FROM movies GROUP BY title)
    SELECT title, movieId, movieId IS NULL AS unmatched FROM asked LEFT JOIN known USING (title)""",
)
def title_lookup(t):
    real = t.movies().select("title").distinct()
    asked = real.unionByName(real.select(F.concat(F.lit("no "), "title").alias("title")))
    return catalog.titles_to_ids(asked, t.movies()).withColumn("unmatched", F.col("movieId").isNull())


HIDDEN = """, hidden AS (
        SELECT movieId, title FROM movies
        WHERE genres NOT LIKE 'SMALL|%' AND genres NOT LIKE 'ECONOMY|%' AND genres NOT LIKE '%|Brand#7'),
    spare AS (SELECT movieId, title FROM movies WHERE genres NOT LIKE '%|Brand#7'),
    raw AS (
        SELECT userId, movieId, h.title AS title FROM ratings LEFT JOIN hidden h USING (movieId)),
    filled AS (
        SELECT raw.userId, raw.movieId, coalesce(raw.title, spare.title) AS title
        FROM raw LEFT JOIN spare USING (movieId))"""


def _partly_titled(t):
    """Ratings against a catalogue that lacks two types of item; both it and the spare one lack
    a brand."""
    spare = t.movies().where(~F.col("genres").endswith("|Brand#7"))
    small = F.col("genres").startswith("SMALL|") | F.col("genres").startswith("ECONOMY|")
    hidden = spare.where(~small).select("movieId", "title")
    spare = spare.select("movieId", "title")
    raw = catalog.with_titles(t.ratings().select("userId", "movieId"), hidden)
    return raw, catalog.fill_titles(raw, spare)


@query(
    "title_fill",
    views("ratings", "movies")
    + HIDDEN
    + """ SELECT coalesce(title, '(unknown title)') AS title, count(*) AS n
    FROM filled GROUP BY 1""",
)
def title_fill(t):
    _, filled = _partly_titled(t)
    named = catalog.placeholder_titles(filled)
    return named.groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@query(
    "missing_title_check",
    views("ratings", "movies")
    + HIDDEN
    + """, both_sides AS (
        SELECT 'before' AS stage, title FROM raw UNION ALL SELECT 'after', title FROM filled)
    SELECT stage, count(*) AS n_rows,
           round(avg(CASE WHEN title IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS missing_ratio,
           avg(CASE WHEN title IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) > 0.5 AS mismatch
    FROM both_sides GROUP BY stage""",
)
def missing_title_check(t):
    raw, filled = _partly_titled(t)
    checks = [
        catalog.missing_title_check(rows).withColumn("stage", F.lit(stage))
        for stage, rows in (("before", raw), ("after", filled))
    ]
    both = checks[0].unionByName(checks[1])
    return both.withColumn("missing_ratio", rounded(F.col("missing_ratio")))


@query(
    "merge_feedback",
    views("ratings", "purchases")
    + """, merged AS (
        SELECT userId, movieId, rating, "timestamp" FROM ratings
        UNION ALL SELECT userId, movieId, rating, NULL FROM purchases)
    SELECT movieId, count(*) AS n, count("timestamp") AS n_timed, sum(rating) AS total
    FROM merged GROUP BY movieId""",
)
def merge_feedback(t):
    merged = rt.merge_feedback(t.ratings(), t.purchases().drop("timestamp"))
    return merged.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("timestamp").alias("n_timed"),
        F.sum("rating").alias("total"),
    )


@query(
    "coerce_ids",
    """WITH texts AS (
        SELECT p_partkey, CASE p_partkey % 5
            WHEN 0 THEN ' ' || p_partkey || ' ' WHEN 1 THEN p_partkey || '.0'
            WHEN 2 THEN p_partkey || '.5' WHEN 3 THEN p_name ELSE CAST(p_partkey AS VARCHAR) END AS txt
        FROM part)
    SELECT p_partkey,
           CASE WHEN TRY_CAST(trim(txt) AS DOUBLE) = floor(TRY_CAST(trim(txt) AS DOUBLE))
                THEN TRY_CAST(TRY_CAST(trim(txt) AS DOUBLE) AS INTEGER) END AS movieId
    FROM texts""",
)
def coerce_ids(t):
    key = F.col("p_partkey")
    kind = key % 5
    text = (
        F.when(kind == 0, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(kind == 1, F.concat(key, F.lit(".0")))
        .when(kind == 2, F.concat(key, F.lit(".5")))
        .when(kind == 3, F.col("p_name"))
        .otherwise(key.cast("string"))
    )
    return t.table("part").select("p_partkey", lenient_id(text).alias("movieId"))


@query(
    "rating_scale_check",
    """WITH given AS (
        SELECT l_partkey AS movieId, l_quantity / CAST(4 AS DOUBLE) AS rating FROM lineitem)
    SELECT movieId, rating BETWEEN 0.5 AND 5 AND rating * 2 = floor(rating * 2) AS valid,
           count(*) AS n
    FROM given GROUP BY 1, 2""",
)
def rating_scale_check(t):
    given = t.table("lineitem").select(
        F.col("l_partkey").alias("movieId"), (F.col("l_quantity") / 4.0).alias("rating")
    )
    checked = given.withColumn("valid", on_rating_scale("rating"))
    return checked.groupBy("movieId", "valid").agg(F.count(F.lit(1)).alias("n"))


@query(
    "hash_split_counts",
    views("ratings")
    + """, sides AS (
        SELECT CASE WHEN CAST('0x' || substr(md5(userId || ':' || movieId), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'val' END AS side,
               rating
        FROM ratings)
    SELECT side, count(*) AS n, round(avg(rating), 6) AS mean FROM sides GROUP BY side""",
)
def hash_split_counts(t):
    train, val = rt.hash_split(t.ratings())
    sides = train.select(F.lit("train").alias("side"), "rating").unionByName(
        val.select(F.lit("val").alias("side"), "rating")
    )
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("rating")).alias("mean")
    )
