"""Known users: ALS, neighbour lists from histories, fallback chains."""

from pyspark.sql import functions as F

from palate.operators import als, codes, evaluate, explain, fallback, neighbors
from palate.operators import ratings as rt
from palate.operators.weighting import rating_entries
from palate.plans.registry import query, views
from palate.plans.similarity import item_pairs
from palate.session import checkpoint_root, settle, work_path
from palate.sources import readers, writers

SETTINGS = als.AlsSettings()


def model_of(t):
    """The model of these ratings: read where it is stored, else fitted and stored.

    The path holds a count and a sum over the rows that the model was fitted to, so other data have
    another model.
    """
    train, _ = rt.hash_split(t.ratings())
    row_sum = F.sum(F.xxhash64("userId", "movieId", "rating").cast("decimal(38,0)"))
    mark = train.agg(F.count("*").alias("n"), F.coalesce(row_sum, F.lit(0)).alias("rows")).first()
    path = f"{checkpoint_root(t.spark)}/palate/als-{SETTINGS.rank}-{SETTINGS.max_iter}-{mark['n']}-{mark['rows']}"
    model = readers.load_als_or_none(t.spark, path)
    if model is None:
        writers.write_model(als.fit(train, SETTINGS), path)
        model = readers.load_als_or_none(t.spark, path)  # what the fit holds can go
    return model


def users_and_strangers(t):
    """Every customer, and every supplier as somebody who never rated (negative ids)."""
    customers = t.table("customer").select(F.col("c_custkey").alias("userId"))
    strangers = t.table("supplier").select((-F.col("s_suppkey") - 1).alias("userId"))
    return customers.unionByName(strangers)


USERS_SQL = """, users AS (
        SELECT c_custkey AS userId FROM customer UNION ALL SELECT -s_suppkey - 1 FROM supplier)"""

HISTORY_SQL = """, by_history AS (
        SELECT r.userId, n.neighborId AS movieId, round(sum(n.similarity * r.rating), 9) AS score,
               max(n.similarity) AS max_sim
        FROM ratings r JOIN neighbors n ON n.movieId = r.movieId
        GROUP BY r.userId, n.neighborId),
    history_best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId)
                       AS INTEGER) AS rank
        FROM by_history)"""

SIMS_SQL = item_pairs("dot / (x.norm * y.norm)")

CENTRAL_SQL = """, central AS (
        SELECT neighborId AS movieId, round(avg(similarity), 12) AS score
        FROM neighbors GROUP BY neighborId),
    central_best AS (
        SELECT *, CAST(row_number() OVER (ORDER BY score DESC, movieId) AS INTEGER) AS rank FROM central)"""


def item_sims(t):
    return settle(neighbors.rating_neighbors(t.ratings(), top_n=10), "item-sims")


@query(
    "neighbors_weighted_history",
    views("norms") + SIMS_SQL + HISTORY_SQL
    + " SELECT userId, movieId, score, rank FROM history_best WHERE rank <= 10",
)
def neighbors_weighted_history(t):
    return fallback.neighbors_for_users(t.ratings(), item_sims(t), k=10)


@query(
    "history_scores",
    views("norms") + SIMS_SQL + HISTORY_SQL + " SELECT userId, movieId, score, max_sim FROM by_history",
)
def history_scores(t):
    """Every score a history gives, not only the best."""
    return fallback.score_by_history(t.ratings(), item_sims(t))


@query(
    "neighbors_unseen_history",
    views("norms") + SIMS_SQL + HISTORY_SQL
    + """, unseen AS (
        SELECT userId, movieId, score, CAST(row_number() OVER (
            PARTITION BY userId ORDER BY score DESC, movieId) AS INTEGER) AS rank
        FROM by_history h WHERE NOT EXISTS (
            SELECT 1 FROM ratings r WHERE r.userId = h.userId AND r.movieId = h.movieId))
    SELECT userId, movieId, score, rank FROM unseen WHERE rank <= 10""",
)
def neighbors_unseen_history(t):
    return fallback.neighbors_for_users(t.ratings(), item_sims(t), k=10, exclude_seen=True)


@query(
    "neighbors_centrality",
    views("norms") + SIMS_SQL + CENTRAL_SQL
    + " SELECT movieId, score, rank FROM central_best WHERE rank <= 10",
)
def neighbors_centrality(t):
    return fallback.central_items(item_sims(t), k=10)


@query(
    "fallback_chain_static",
    views("norms", "evts") + SIMS_SQL + HISTORY_SQL + CENTRAL_SQL + USERS_SQL
    + """, viewed AS (
        SELECT userId, movieId, round(avg(value), 6) AS score FROM evts
        WHERE eventType = 'view' GROUP BY userId, movieId),
    viewed_best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId)
                       AS INTEGER) AS rank
        FROM viewed),
    first_users AS (SELECT userId FROM users WHERE userId IN (SELECT userId FROM viewed)),
    second_users AS (
        SELECT userId FROM users WHERE userId NOT IN (SELECT userId FROM first_users)
        AND userId IN (SELECT userId FROM ratings)),
    third_users AS (
        SELECT userId FROM users WHERE userId NOT IN (SELECT userId FROM first_users)
        AND userId NOT IN (SELECT userId FROM ratings))
    SELECT userId, movieId, score, rank, 'scored_views' AS source
    FROM viewed_best JOIN first_users USING (userId) WHERE rank <= 10
    UNION ALL
    SELECT userId, movieId, score, rank, 'neighbors_history'
    FROM history_best JOIN second_users USING (userId) WHERE rank <= 10
    UNION ALL
    SELECT userId, movieId, score, rank, 'neighbors_central'
    FROM central_best CROSS JOIN third_users WHERE rank <= 10""",
)
def fallback_chain_static(t):
    """Precomputed lists first, then neighbours of the history, then central items."""
    views_ = t.events().where(F.col("eventType") == "view")
    scores = views_.groupBy("userId", "movieId").agg(F.round(F.avg("value"), 6).alias("score"))
    sims, history = item_sims(t), t.ratings()
    branches = [
        fallback.table_branch("scored_views", scores, 10),
        fallback.history_branch(history, sims, 10),
        fallback.centrality_branch(sims, history, 10),
        fallback.popularity_branch(history, 10),
    ]
    return fallback.chain(users_and_strangers(t), branches)


@query(
    "fallback_popularity_static",
    views("stats") + USERS_SQL
    + """, best AS (
        SELECT movieId, round(n * mean, 6) AS score,
               CAST(row_number() OVER (ORDER BY round(n * mean, 6) DESC, movieId) AS INTEGER) AS rank
        FROM stats)
    SELECT userId, movieId, score, rank, 'popularity' AS source
    FROM users CROSS JOIN best WHERE rank <= 10""",
)
def fallback_popularity_static(t):
    """The two-step chain before any model exists: everybody gets support times mean."""
    return fallback.recommend_two_step(users_and_strangers(t), t.ratings(), None, k=10)


WIDE = 2**40

CODES_SQL = f""" SELECT id + {WIDE} AS id, CAST(dense_rank() OVER (PARTITION BY side ORDER BY id) - 1 AS INTEGER) AS code, side
    FROM (SELECT DISTINCT userId AS id, 'user' AS side FROM ratings UNION SELECT DISTINCT movieId, 'item' FROM ratings)"""


def wide_ratings(t):
    """The ratings with ids that need 41 bits."""
    return t.ratings().withColumns({c: F.col(c) + F.lit(WIDE) for c in ("userId", "movieId")})


@query("dense_codes", views("ratings") + CODES_SQL)
def dense_codes(t):
    ratings = wide_ratings(t)
    sides = [
        codes.dense_codes(ratings, c).select(F.col(c).alias("id"), "code", F.lit(side).alias("side"))
        for c, side in (("userId", "user"), ("movieId", "item"))
    ]
    return sides[0].unionByName(sides[1])


@query(
    "als_wide_ids",
    views("ratings")
    + f""" SELECT userId + {WIDE} AS userId, CAST(10 AS BIGINT) AS n, CAST(0 AS BIGINT) AS unknown, CAST(0 AS BIGINT) AS off
    FROM ratings GROUP BY userId""",
)
def als_wide_ids(t):
    """A model over wide ids, stored and read again: every user's list is complete, of rated items, and
    scored as the model predicts."""
    ratings = wide_ratings(t)
    path = work_path(t.spark, "coded-model")
    codes.save_coded(codes.fit_coded(ratings, SETTINGS), path)
    model = codes.load_coded(t.spark, path)
    lists = settle(codes.recommend_coded(model, k=10), "wide-lists")
    rated = ratings.select("movieId").distinct().withColumn("rated", F.lit(1))
    checked = codes.predict_coded(model, lists).join(rated, "movieId", "left")
    return checked.groupBy("userId").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("rated").isNull()).alias("unknown"),
        F.count_if(F.abs(F.col("score") - F.col("prediction")) > 1e-4).alias("off"),
    )


@query("als_predict")
def als_predict(t):
    _, val = rt.hash_split(t.ratings())
    return als.predict(model_of(t), val.select("userId", "movieId", "rating"))


@query("als_rmse")
def als_rmse(t):
    train, val = rt.hash_split(t.ratings())
    model_error = evaluate.rmse_table(als.predict(model_of(t), val)).withColumn("model", F.lit("als"))
    mean_error = evaluate.mean_predictor_rmse(train, val).withColumn("model", F.lit("mean"))
    return model_error.unionByName(mean_error)


@query("als_recommend_subset")
def als_recommend_subset(t):
    active = t.events().select("userId").distinct()
    return als.recommend_users(model_of(t), active, k=10)


@query("als_recommend_all")
def als_recommend_all(t):
    return als.recommend_everyone(model_of(t), k=10)


@query("als_item_factors")
def als_item_factors(t):
    return model_of(t).itemFactors


@query("als_neighbors")
def als_neighbors(t):
    return neighbors.precompute_neighbors(model_of(t).itemFactors, top_n=10, method="exact")


@query("als_grid")
def als_grid(t):
    train, val = rt.hash_split(t.ratings())
    return als.grid_search(train, val).results


@query("als_implicit")
def als_implicit(t):
    """Views and clicks as confidence, not ratings."""
    seen = t.events().where(F.col("eventType").isin("view", "click"))
    counts = seen.groupBy("userId", "movieId").agg(F.count(F.lit(1)).alias("rating"))
    model = als.fit(counts, als.AlsSettings(implicit=True))
    return als.recommend_everyone(model, k=5)


@query("als_explain")
def als_explain(t):
    model = model_of(t)
    active = t.events().select("userId").distinct()
    recs = als.recommend_users(model, active, k=5)
    history = rt.resolve_duplicates(t.ratings(), "latest")
    return explain.explain_by_factors(recs, history, model.itemFactors, m=3)


@query("fallback_chain_als")
def fallback_chain_als(t):
    model = model_of(t)
    sims = settle(neighbors.factor_neighbors(model.itemFactors, top_n=10), "item-sims")
    return fallback.recommend_with_fallback(
        users_and_strangers(t), k=10, model=model, neighbors=sims, history=t.ratings()
    )


@query("fallback_two_step")
def fallback_two_step(t):
    return fallback.recommend_two_step(users_and_strangers(t), t.ratings(), model_of(t), k=10)


@query(
    "user_history_rows",
    views("ratings", "evts")
    + """ SELECT userId, movieId, rating FROM ratings
    WHERE userId IN (SELECT userId FROM evts WHERE eventType = 'signup')""",
)
def user_history_rows(t):
    from palate.operators.catalog import user_history

    signed_up = t.events().where(F.col("eventType") == "signup")
    return user_history(t.ratings(), signed_up)


@query(
    "entries_matrix",
    views("entries", "norms")
    + """ SELECT e.userId, e.movieId, e.rating, round(norm, 6) AS norm, raters
    FROM entries e JOIN norms n ON n.movieId = e.movieId""",
)
def entries_matrix(t):
    entries = rating_entries(t.ratings())
    norms = rt.item_norms(entries).withColumn("norm", F.round("norm", 6))
    return entries.join(norms, "movieId")
