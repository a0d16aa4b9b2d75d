"""Declared schemas of every table the library reads or writes."""

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("userId", T.IntegerType(), False),
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("rating", T.FloatType(), False),
        T.StructField("timestamp", T.LongType(), True),
    ]
)

#: Feedback has the columns of ratings, but a client may leave any of them out.
FEEDBACK = T.StructType([T.StructField(f.name, f.dataType, True) for f in RATINGS])

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.IntegerType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("genres", T.StringType(), True),
    ]
)

REVIEWS = T.StructType(
    [
        T.StructField("ts_utc", T.StringType(), True),
        T.StructField("mode", T.StringType(), True),
        T.StructField("movieId", T.IntegerType(), True),
        T.StructField("rating", T.DoubleType(), True),
        T.StructField("comment", T.StringType(), True),
    ]
)

FACTORS = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("features", T.ArrayType(T.FloatType()), True),
    ]
)

NEIGHBORS = T.StructType(
    [
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("neighborId", T.IntegerType(), False),
        T.StructField("similarity", T.DoubleType(), False),
        T.StructField("rank", T.IntegerType(), False),
    ]
)

#: Flat recommendation rows; ``source`` names the branch that produced the row.
RECOMMENDATIONS = T.StructType(
    [
        T.StructField("userId", T.IntegerType(), False),
        T.StructField("movieId", T.IntegerType(), False),
        T.StructField("score", T.DoubleType(), True),
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("source", T.StringType(), False),
    ]
)
