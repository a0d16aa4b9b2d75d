"""Cold start, item neighbours and factor similarity."""

from pyspark.sql import functions as F

from palate.functions.vectors import cosine_from_distance
from palate.operators import coldstart, content, diversity, neighbors
from palate.operators.favorites import recommend_for_favorites, recommend_near_items
from palate.operators.ranking import rounded
from palate.operators.weighting import rating_entries
from palate.plans.registry import VIEWS, query, views

TOP = 20

#: Every customer with purchases is a newcomer who likes what they bought (repeats count) plus
#: one item nobody rated; people with errors but no purchase know only that item.
SEEDS_SQL = """, seeds AS (
        SELECT userId AS queryId, movieId FROM purchases
        UNION ALL SELECT DISTINCT userId, -1 FROM evts WHERE eventType = 'error'),
    seed_entries AS (
        SELECT DISTINCT seeds.movieId AS seedId, userId, rating
        FROM seeds JOIN entries USING (movieId)),
    dots AS (
        SELECT seedId, e.movieId, sum(s.rating * e.rating) AS dot, count(*) AS overlap
        FROM seed_entries s JOIN entries e USING (userId)
        WHERE e.movieId <> seedId GROUP BY seedId, e.movieId),
    sims AS (
        SELECT seedId, d.movieId, overlap,
               CASE WHEN a.norm * b.norm = 0 THEN 0 ELSE dot / (a.norm * b.norm) END AS cosine
        FROM dots d JOIN norms a ON a.movieId = seedId JOIN norms b ON b.movieId = d.movieId)"""


def scored_seeds(similarity: str) -> str:
    return f""", scored AS (
        SELECT queryId, sims.movieId, round(sum({similarity}), 6) AS score
        FROM seeds JOIN sims ON seeds.movieId = sims.seedId
        GROUP BY queryId, sims.movieId HAVING round(sum({similarity}), 6) <> 0),
    allowed AS (
        SELECT * FROM scored WHERE NOT EXISTS (
            SELECT 1 FROM seeds
            WHERE seeds.queryId = scored.queryId AND seeds.movieId = scored.movieId)),
    best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY queryId ORDER BY score DESC, movieId)
                       AS INTEGER) AS rank
        FROM allowed)"""


BEST_SQL = f" SELECT queryId, movieId, score, rank FROM best WHERE rank <= {TOP}"
PLAIN = "sims.cosine"
SHRUNK = "sims.cosine * overlap / (overlap + CAST(100 AS DOUBLE))"


def seeds(t):
    bought = t.purchases().select(F.col("userId").alias("queryId"), "movieId")
    unlucky = t.events().where(F.col("eventType") == "error")
    unknown = unlucky.select(F.col("userId").alias("queryId")).distinct()
    return bought.unionByName(unknown.withColumn("movieId", F.lit(-1).cast("bigint")))


@query("coldstart_cosine", views("norms", "purchases") + SEEDS_SQL + scored_seeds(PLAIN) + BEST_SQL)
def coldstart_cosine(t):
    return coldstart.recommend_for_seeds(t.ratings(), seeds(t), k=TOP)


@query("coldstart_shrunk", views("norms", "purchases") + SEEDS_SQL + scored_seeds(SHRUNK) + BEST_SQL)
def coldstart_shrunk(t):
    return coldstart.recommend_for_seeds(t.ratings(), seeds(t), k=TOP, shrink=coldstart.SHRINK)


def weighted_entries(weight: str) -> str:
    """Views in which ``entries`` carries a weight instead of the plain rating sum."""
    base = views("entries").replace("entries AS", "plain AS")
    return (
        base
        + f""", users AS (SELECT userId, count(*) AS df FROM plain GROUP BY userId),
    lens AS (SELECT movieId, sum(rating) AS len FROM plain GROUP BY movieId),
    weighted AS (
        SELECT userId, movieId, rating AS x, len,
               ln((SELECT count(DISTINCT movieId) FROM plain) / CAST(df AS DOUBLE)) AS idf,
               (SELECT avg(len) FROM lens) AS avglen
        FROM plain JOIN users USING (userId) JOIN lens USING (movieId)),
    entries AS (SELECT userId, movieId, {weight} AS rating FROM weighted),
    """
        + VIEWS["norms"]
        + ",\n"
        + VIEWS["evts"]
        + ",\n"
        + VIEWS["purchases"]
    )


TFIDF = "x * idf"
BM25 = """x * CAST(2.2 AS DOUBLE)
    / (x + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * len / avglen)) * idf"""


@query("coldstart_tfidf", weighted_entries(TFIDF) + SEEDS_SQL + scored_seeds(PLAIN) + BEST_SQL)
def coldstart_tfidf(t):
    return coldstart.recommend_for_seeds(t.ratings(), seeds(t), k=TOP, weighting="tfidf")


@query("coldstart_bm25", weighted_entries(BM25) + SEEDS_SQL + scored_seeds(PLAIN) + BEST_SQL)
def coldstart_bm25(t):
    return coldstart.recommend_for_seeds(t.ratings(), seeds(t), k=TOP, weighting="bm25")


@query(
    "coldstart_excluding",
    views("norms", "purchases")
    + SEEDS_SQL.replace("seeds AS (", "all_seeds AS (", 1).replace(
        "\n    seed_entries",
        """
    seeds AS (SELECT queryId, movieId FROM all_seeds WHERE movieId >= 0),
    seed_entries""",
        1,
    )
    + """, barred AS (
        SELECT queryId, movieId FROM seeds
        UNION SELECT userId, movieId FROM evts WHERE eventType = 'view'),
    rated AS (SELECT DISTINCT movieId FROM ratings),
    scored AS (
        SELECT queryId, r.movieId, round(coalesce(sum(cosine), 0), 6) AS score
        FROM seeds CROSS JOIN rated r
        LEFT JOIN sims ON sims.seedId = seeds.movieId AND sims.movieId = r.movieId
        GROUP BY queryId, r.movieId),
    best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY queryId ORDER BY score DESC, movieId)
                       AS INTEGER) AS rank
        FROM scored WHERE NOT EXISTS (
            SELECT 1 FROM barred
            WHERE barred.queryId = scored.queryId AND barred.movieId = scored.movieId))
    SELECT queryId, movieId, score, rank FROM best WHERE rank <= 1500""",
)
def coldstart_excluding(t):
    """Everybody's purchases, viewed items barred, lists long enough to need zeros."""
    bought = seeds(t).where(F.col("movieId") >= 0)
    viewed = t.events().where(F.col("eventType") == "view")
    viewed = viewed.select(F.col("userId").alias("queryId"), "movieId")
    return coldstart.recommend_for_seeds(
        t.ratings(), bought, k=1500, exclude=viewed, include_zero=True
    )


@query(
    "coldstart_explain",
    views("norms", "purchases")
    + SEEDS_SQL
    + scored_seeds(PLAIN)
    + f""", parts AS (
        SELECT best.queryId, best.movieId, best.rank, seedId,
               round(cosine * count(*), 6) AS contribution
        FROM best JOIN seeds ON seeds.queryId = best.queryId
        JOIN sims ON sims.seedId = seeds.movieId AND sims.movieId = best.movieId
        WHERE best.rank <= {TOP}
        GROUP BY best.queryId, best.movieId, best.rank, seedId, cosine),
    reasons AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY queryId, movieId
                       ORDER BY contribution DESC, seedId) AS INTEGER) AS reason_rank
        FROM parts)
    SELECT * FROM reasons WHERE reason_rank <= 2""",
)
def coldstart_explain(t):
    return coldstart.recommend_with_reasons(rating_entries(t.ratings()), seeds(t), k=TOP, m=2)[1]


def item_pairs(similarity: str) -> str:
    return f""", pairs AS (
        SELECT a.movieId, b.movieId AS neighborId, sum(a.rating * b.rating) AS dot, count(*) AS overlap
        FROM entries a JOIN entries b ON a.userId = b.userId AND a.movieId <> b.movieId
        GROUP BY a.movieId, b.movieId),
    item_sims AS (
        SELECT p.movieId, neighborId, round({similarity}, 6) AS similarity
        FROM pairs p JOIN norms x ON x.movieId = p.movieId JOIN norms y ON y.movieId = neighborId),
    neighbors AS (
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY movieId
                           ORDER BY similarity DESC, neighborId) AS INTEGER) AS rank
            FROM item_sims) WHERE rank <= 10)"""


@query(
    "item_item_cosine_topn",
    views("norms") + item_pairs("dot / (x.norm * y.norm)")
    + " SELECT movieId, neighborId, similarity, rank FROM neighbors",
)
def item_item_cosine_topn(t):
    return neighbors.rating_neighbors(t.ratings(), top_n=10)


@query(
    "item_item_shrunk_topn",
    views("norms") + item_pairs("dot / (x.norm * y.norm) * overlap / (overlap + CAST(100 AS DOUBLE))")
    + " SELECT movieId, neighborId, similarity, rank FROM neighbors",
)
def item_item_shrunk_topn(t):
    return neighbors.rating_neighbors(t.ratings(), top_n=10, shrink=coldstart.SHRINK)


@query(
    "item_item_bm25_topn",
    weighted_entries(BM25) + item_pairs("dot / (x.norm * y.norm)")
    + " SELECT movieId, neighborId, similarity, rank FROM neighbors",
)
def item_item_bm25_topn(t):
    return neighbors.rating_neighbors(t.ratings(), top_n=10, weighting="bm25")


COSINE_SQL = """CASE WHEN a.norm * b.norm = 0 THEN 0
    ELSE list_dot_product(a.features, b.features) / (a.norm * b.norm) END"""


@query(
    "factor_topn_exact",
    views("factors")
    + f""", pairs AS (
        SELECT a.id AS movieId, b.id AS neighborId, round({COSINE_SQL}, 6) AS similarity
        FROM factors a JOIN factors b ON a.id <> b.id),
    best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY movieId
                       ORDER BY similarity DESC, neighborId) AS INTEGER) AS rank
        FROM pairs)
    SELECT movieId, neighborId, similarity, rank FROM best WHERE rank <= 10""",
)
def factor_topn_exact(t):
    return neighbors.factor_neighbors(t.factors(), top_n=10)


@query("factor_topn_lsh")
def factor_topn_lsh(t):
    return neighbors.lsh_neighbors(t.factors(), top_n=10, cos_threshold=0.30)


@query(
    "lsh_radius_pairs",
    views("factors")
    + """, pairs AS (
        SELECT a.id AS movieId, b.id AS neighborId,
               sqrt(greatest(0, 2 - 2 * list_dot_product(a.features, b.features) / (a.norm * b.norm))) AS dist
        FROM factors a JOIN factors b ON a.id <> b.id)
    SELECT movieId, neighborId, round(1 - dist * dist / 2, 6) AS similarity
    FROM pairs WHERE dist < sqrt(CAST(1.4 AS DOUBLE))""",
)
def lsh_radius_pairs(t):
    """The radius question LSH approximates, answered exactly."""
    near = neighbors.radius_pairs(t.factors(), 0.30)
    dist = F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * F.col("similarity")))
    return near.select(
        "movieId", "neighborId", rounded(cosine_from_distance(dist)).alias("similarity")
    )


FAVORITES_SQL = """, favs AS (
        SELECT DISTINCT userId AS queryId, movieId FROM purchases),
    scored AS (
        SELECT f.queryId, b.id AS movieId, round(max({cosine}), 6) AS score
        FROM favs f JOIN factors a ON a.id = f.movieId CROSS JOIN factors b
        WHERE NOT EXISTS (SELECT 1 FROM favs g WHERE g.queryId = f.queryId AND g.movieId = b.id)
        GROUP BY f.queryId, b.id),
    best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY queryId ORDER BY score DESC, movieId)
                       AS INTEGER) AS rank
        FROM scored)""".replace("{cosine}", COSINE_SQL)


def favorites(t):
    """What each customer bought."""
    return t.purchases().select(F.col("userId").alias("queryId"), "movieId")


@query(
    "favorites_max_cosine",
    views("factors", "purchases") + FAVORITES_SQL
    + " SELECT queryId, movieId, score, rank FROM best WHERE rank <= 10",
)
def favorites_max_cosine(t):
    return recommend_near_items(favorites(t), t.factors(), k=10)


@query(
    "favorites_zero_lists",
    views("factors", "purchases")
    + FAVORITES_SQL.replace(
        "SELECT DISTINCT userId AS queryId, movieId FROM purchases",
        """SELECT DISTINCT userId AS queryId, movieId FROM purchases WHERE movieId < 50
        UNION SELECT DISTINCT -userId - 1, -movieId - 1 FROM evts WHERE eventType = 'error'""",
    ).replace("round(max(", "round(coalesce(max(").replace("), 6) AS score", "), 0), 6) AS score")
    .replace("JOIN factors a ON", "LEFT JOIN factors a ON")
    .replace("list_dot_product(a.features", "list_dot_product(coalesce(a.features, b.features)")
    + " SELECT queryId, movieId, score, rank FROM best WHERE rank <= 10",
)
def favorites_zero_lists(t):
    """Customers' purchases, and people who only know items without factors."""
    bought = favorites(t).where(F.col("movieId") < 50)
    unlucky = t.events().where(F.col("eventType") == "error")
    strange = unlucky.select((-F.col("userId") - 1).alias("queryId"), (-F.col("movieId") - 1).alias("movieId"))
    return recommend_near_items(bought.unionByName(strange), t.factors(), k=10, include_zero=True)


@query(
    "favorites_by_title",
    views("factors", "movies")
    + """, favs AS (
        SELECT min(movieId) OVER (PARTITION BY title) AS queryId, title, movieId FROM movies),
    scored AS (
        SELECT f.queryId, b.id AS movieId, round(max({cosine}), 6) AS score
        FROM favs f JOIN factors a ON a.id = f.movieId CROSS JOIN factors b
        JOIN movies m ON m.movieId = b.id
        WHERE NOT EXISTS (SELECT 1 FROM favs g WHERE g.queryId = f.queryId AND g.movieId = b.id)
        GROUP BY f.queryId, b.id),
    best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY queryId ORDER BY score DESC, movieId)
                       AS INTEGER) AS rank
        FROM scored)
    SELECT queryId, movieId, title, printf('%.6f', score) AS score_text, rank
    FROM best JOIN movies USING (movieId) WHERE rank <= 10""".replace("{cosine}", COSINE_SQL),
)
def favorites_by_title(t):
    """Every title as a favourite, asking for movies close to any that bear it."""
    from palate.functions.columns import fixed_score

    asked = t.movies().groupBy("title").agg(F.min("movieId").alias("queryId"))
    best = recommend_for_favorites(asked, t.movies(), t.factors(), k=10)
    return best.withColumn("score_text", fixed_score("score", 6)).drop("score")


@query(
    "hybrid_score",
    views("factors", "movies")
    + """, profiles AS (
        SELECT movieId AS id, features, norm, list_distinct(string_split(genres, '|')) AS tags
        FROM movies LEFT JOIN factors ON id = movieId),
    pairs AS (
        SELECT a.id AS movieId, b.id AS neighborId,
               coalesce(list_dot_product(a.features, b.features) / (a.norm * b.norm), 0) AS cosine,
               len(list_intersect(a.tags, b.tags)) AS both_tags,
               len(a.tags) + len(b.tags) - len(list_intersect(a.tags, b.tags)) AS all_tags
        FROM profiles a JOIN profiles b ON a.id <> b.id),
    scored AS (
        SELECT movieId, neighborId,
               round(CAST(0.7 AS DOUBLE) * cosine + CAST(0.3 AS DOUBLE) * both_tags / all_tags, 6) AS score
        FROM pairs),
    best AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY movieId ORDER BY score DESC, neighborId)
                       AS INTEGER) AS rank
        FROM scored)
    SELECT movieId, neighborId, score, rank FROM best WHERE rank <= 5""",
)
def hybrid_score(t):
    profiles = content.item_profiles(t.factors(), t.movies())
    return content.hybrid_neighbors(profiles, k=5, factor_weight=0.7)


@query(
    "mmr_rerank",
    views("factors", "purchases")
    + FAVORITES_SQL
    + """, pool AS (SELECT queryId, movieId, score FROM best WHERE rank <= 40),
    near AS (
        SELECT p.queryId, p.movieId, o.movieId AS otherId, {cosine} AS cosine
        FROM pool p JOIN pool o USING (queryId)
        JOIN factors a ON a.id = p.movieId JOIN factors b ON b.id = o.movieId),
    """.replace("{cosine}", COSINE_SQL).replace(
        "near AS (", "near AS MATERIALIZED (")
    + ",\n    ".join(
        ["""pick1 AS (
        SELECT * FROM (
            SELECT queryId, movieId, score, round(CAST(0.7 AS DOUBLE) * score, 9) AS mmr, 1 AS rank,
                   row_number() OVER (PARTITION BY queryId
                       ORDER BY round(CAST(0.7 AS DOUBLE) * score, 9) DESC, movieId) AS rn
            FROM pool) WHERE rn = 1)"""]
        + [
            f"""pick{n} AS MATERIALIZED (
        SELECT queryId, movieId, score, mmr, rank, rn FROM pick{n - 1}
        UNION ALL SELECT * FROM (
            SELECT queryId, movieId, score, mmr, {n} AS rank,
                   row_number() OVER (PARTITION BY queryId ORDER BY mmr DESC, movieId) AS rn
            FROM (
                SELECT p.queryId, p.movieId, p.score,
                       round(CAST(0.7 AS DOUBLE) * p.score - CAST(0.3 AS DOUBLE) * max(n.cosine), 9) AS mmr
                FROM pool p JOIN near n ON n.queryId = p.queryId AND n.movieId = p.movieId
                JOIN pick{n - 1} s ON s.queryId = p.queryId AND s.movieId = n.otherId
                WHERE NOT EXISTS (SELECT 1 FROM pick{n - 1} d
                                  WHERE d.queryId = p.queryId AND d.movieId = p.movieId)
                GROUP BY p.queryId, p.movieId, p.score)) WHERE rn = 1)"""
            for n in range(2, 9)
        ]
    )
    + " SELECT queryId, movieId, score, mmr, CAST(rank AS INTEGER) AS rank FROM pick8",
)
def mmr_rerank(t):
    pool = recommend_near_items(favorites(t), t.factors(), k=40)
    return diversity.mmr_rerank(pool, t.factors(), lam=0.7, k=8, pool=40)
