"""Registry of queries: a Spark callable per name and, where SQL can say it, the SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palate.sources.sales import SalesTables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The views of ``SalesTables`` in SQL, as WITH items.
VIEWS = {
    "ratings": """ratings AS (
        SELECT o_custkey AS userId, l_partkey AS movieId,
               CAST(ceil(l_quantity / 5) AS DOUBLE) / CAST(2 AS DOUBLE) AS rating,
               CAST(floor(epoch(l_shipdate)) AS BIGINT) AS "timestamp"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "movies": """movies AS (
        SELECT p_partkey AS movieId, p_name AS title, p_type || '|' || p_brand AS genres FROM part)""",
    "entries": """entries AS (
        SELECT userId, movieId, sum(rating) AS rating FROM ratings GROUP BY userId, movieId)""",
    "stats": """stats AS (
        SELECT movieId, count(*) AS n, sum(rating) AS total, avg(rating) AS mean
        FROM ratings GROUP BY movieId)""",
    "norms": """norms AS (
        SELECT movieId, sqrt(sum(rating * rating)) AS norm, count(*) AS raters
        FROM entries GROUP BY movieId)""",
    "factors": """factors AS (
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features,
               sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
        FROM embeddings)""",
    "evts": """evts AS (
        SELECT event_id AS eventId, user_id AS userId,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS movieId,
               event_type AS eventType, value, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
        FROM events)""",
    "purchases": """purchases AS (
        SELECT userId, movieId,
               CAST(CAST(floor(abs(value)) AS BIGINT) % 10 + 1 AS DOUBLE) / CAST(2 AS DOUBLE) AS rating,
               "timestamp"
        FROM evts WHERE eventType = 'purchase')""",
}

NEEDS = {
    "entries": ["ratings"],
    "stats": ["ratings"],
    "norms": ["entries"],
    "purchases": ["evts"],
}


def views(*names: str) -> str:
    """``WITH …`` for the named views and whatever they rest on, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(VIEWS[name] for name in ordered)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``."""

    def register(fn: Callable[[SalesTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(SalesTables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
