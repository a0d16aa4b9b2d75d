"""Dense codes for ids, and ALS over ids of any width.

ALS wants ids of 32 bits.  A dictionary gives each distinct id its place in the order of all: ids are
sorted over range partitions, partitions are counted, and a partition's codes follow those of the
partitions before it.  The dictionaries are stored with the model and map its results back, so callers
never meet a code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.operators import als
from palate.operators.ranking import numbered
from palate.operators.ratings import KEYS, resolve_duplicates
from palate.operators.tiles import vector_top_k
from palate.session import settle
from palate.sources import readers, writers

MOST_CODES = 2**31 - 1


def dense_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """``column, code``: codes from 0 on for the distinct ids, in id order; nulls get none.  A stored table."""
    ids = numbered(df.select(column).na.drop().distinct(), [F.asc(column)], "__n")
    code = F.when(F.col("__n") <= MOST_CODES, F.col("__n") - 1).otherwise(F.raise_error(F.lit(f"too many ids in {column}")))
    return settle(ids.select(column, code.cast("int").alias(name)), "codes")


@dataclass(frozen=True)
class CodedModel:
    """A model over codes with the dictionaries ``userId, code`` and ``movieId, code``."""

    model: ALSModel
    users: DataFrame
    items: DataFrame

    def user_factors(self) -> DataFrame:
        """``id, features`` by the users' own ids."""
        return self._factors(self.model.userFactors, self.users, "userId")

    def item_factors(self) -> DataFrame:
        return self._factors(self.model.itemFactors, self.items, "movieId")

    @staticmethod
    def _factors(factors: DataFrame, codes: DataFrame, column: str) -> DataFrame:
        named = codes.select(F.col("code").alias("id"), F.col(column).alias("__id"))
        return factors.join(named, "id").select(F.col("__id").alias("id"), "features")


def _coded(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs`` with codes beside the ids; rows whose ids have none are dropped."""
    named = lambda codes, column: codes.select(column, F.col("code").alias(f"__{column}"))
    return pairs.join(named(users, "userId"), "userId").join(named(items, "movieId"), "movieId")


def fit_coded(ratings: DataFrame, settings: als.AlsSettings = als.AlsSettings()) -> CodedModel:
    """Train on the codes of the ids; duplicates are resolved by the ids first."""
    clean = settle(resolve_duplicates(ratings, settings.policy_for(ratings)), "ratings")
    users, items = dense_codes(clean, "userId"), dense_codes(clean, "movieId")
    rows = _coded(clean, users, items).select(*[F.col(f"__{c}").alias(c) for c in KEYS], "rating")
    return CodedModel(als.fit(rows, settings), users, items)


def predict_coded(coded: CodedModel, pairs: DataFrame) -> DataFrame:
    """Adds ``prediction``; pairs with an unknown user or item are dropped."""
    carried = [c for c in pairs.columns if c not in KEYS]
    rows = _coded(pairs, coded.users, coded.items)
    own = [F.col(c).alias(f"__own_{c}") for c in KEYS]
    scored = coded.model.transform(rows.select(*[F.col(f"__{c}").alias(c) for c in KEYS], *own, *carried))
    return scored.select(*[F.col(f"__own_{c}").alias(c) for c in KEYS], *carried, "prediction")


def recommend_coded(coded: CodedModel, k: int = 10, users: DataFrame | None = None) -> DataFrame:
    """Top ``k`` items of the users asked for, or of all: ``userId, movieId, score, rank``.

    Equal scores go to the smaller id; codes follow the order of the ids, so this holds for both.
    """
    codes = coded.users if users is None else coded.users.join(users.select("userId").distinct(), "userId", "left_semi")
    factors = coded.model.userFactors.join(codes.select(F.col("code").alias("id")), "id", "left_semi")
    best = vector_top_k(factors.select(F.col("id").alias("queryId"), "features"), coded.model.itemFactors, k, metric="dot")
    named = best.join(codes.select(F.col("code").cast("bigint").alias("queryId"), "userId"), "queryId")
    named = named.join(coded.items.select(F.col("code").cast("bigint").alias("id"), "movieId"), "id")
    return named.select("userId", "movieId", "score", "rank")


def save_coded(coded: CodedModel, path: str) -> None:
    writers.write_model(coded.model, f"{path}/model")
    coded.users.write.mode("overwrite").parquet(f"{path}/users")
    coded.items.write.mode("overwrite").parquet(f"{path}/items")


def load_coded(spark: SparkSession, path: str) -> CodedModel:
    return CodedModel(readers.load_als(f"{path}/model"), spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"))
