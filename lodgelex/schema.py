"""Shape of a listing document and of the tables derived from it."""

from __future__ import annotations

from pyspark.sql import types as T

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.LongType()),
        T.StructField("summary", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField(
            "address",
            T.StructType(
                [
                    T.StructField("country", T.StringType()),
                    T.StructField("market", T.StringType()),
                    T.StructField(
                        "location",
                        T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))]),
                    ),
                ]
            ),
        ),
        T.StructField(
            "review_scores",
            T.StructType([T.StructField("review_scores_rating", T.IntegerType())]),
        ),
        T.StructField("number_of_reviews", T.IntegerType()),
        T.StructField("bedrooms", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("room_type", T.StringType()),
    ]
)

SCORE_LEXICON = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("value", T.IntegerType())]
)

CLASS_LEXICON = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("sentiment", T.StringType())]
)

TOPIC_TERMS = T.StructType(
    [
        T.StructField("topic", T.IntegerType()),
        T.StructField("term", T.StringType()),
        T.StructField("beta", T.DoubleType()),
    ]
)
