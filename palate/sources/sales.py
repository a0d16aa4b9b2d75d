"""Rating, catalogue, factor and feedback views over a sales schema.

Line items act as ratings (customer rates part), parts as the catalogue, embeddings as item
factors, and the event log as user feedback.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.functions.columns import wall_clock_epoch


@dataclass(frozen=True)
class SalesTables:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def ratings(self) -> DataFrame:
        """``userId, movieId, rating, timestamp``: quantity 1…50 becomes half stars 0.5…5.0."""
        items = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
        buyers = self.table("orders").select("o_orderkey", "o_custkey")
        joined = items.join(buyers, items["l_orderkey"] == buyers["o_orderkey"])
        return joined.select(
            F.col("o_custkey").alias("userId"),
            F.col("l_partkey").alias("movieId"),
            (F.ceil(F.col("l_quantity") / 5) / F.lit(2.0)).alias("rating"),
            wall_clock_epoch("l_shipdate").alias("timestamp"),
        )

    def movies(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("movieId"),
            F.col("p_name").alias("title"),
            F.concat_ws("|", "p_type", "p_brand").alias("genres"),
        )

    def factors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").alias("features")
        )

    @staticmethod
    def shape_events(raw: DataFrame) -> DataFrame:
        """``eventId, userId, movieId, eventType, value, timestamp``; the item sits in the props."""
        return raw.select(
            F.col("event_id").alias("eventId"),
            F.col("user_id").alias("userId"),
            F.get_json_object("props", "$.k").cast("bigint").alias("movieId"),
            F.col("event_type").alias("eventType"),
            "value",
            wall_clock_epoch("ts").alias("timestamp"),
        )

    @staticmethod
    def shape_purchases(events: DataFrame) -> DataFrame:
        """Purchases as feedback; the amount is folded onto the half-star scale."""
        bought = events.where(F.col("eventType") == "purchase")
        return bought.withColumn("rating", half_stars("value")).select(
            "userId", "movieId", "rating", "timestamp"
        )

    def events(self) -> DataFrame:
        return self.shape_events(self.table("events"))

    def purchases(self) -> DataFrame:
        return self.shape_purchases(self.events())


def half_stars(amount: str):
    """Any amount to 0.5…5.0: whole units modulo ten, plus one, halved."""
    return (F.pmod(F.floor(F.abs(F.col(amount))), F.lit(10).cast("bigint")) + 1) / F.lit(2.0)
