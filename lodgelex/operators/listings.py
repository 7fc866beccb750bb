"""Projections, predicates and plain aggregates over listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .identifiers import contiguous_ids

RATING = "review_scores_rating"


def flatten(listings: DataFrame, numbered: bool = False) -> DataFrame:
    """Lift the nested fields in use to the top level; the natural key becomes ``document_id``.

    With ``numbered`` the listings are numbered 1..n in the order of that key instead, whatever its
    type is and however many listings share or lack it.
    """
    flat = listings.select(
        F.col("_id").alias("document_id"),
        F.col("address.country").alias("country"),
        F.col("address.market").alias("market"),
        F.col("summary").alias("text"),
        "description",
        F.col("review_scores.review_scores_rating").alias(RATING),
        "number_of_reviews",
        "bedrooms",
        "price",
        "room_type",
        F.col("address.location.coordinates").alias("coordinates"),
    )
    if not numbered:
        return flat
    keyed = flat.withColumnRenamed("document_id", "_key")
    return contiguous_ids(keyed, "_key").select(*flat.columns)


def descriptions(flat: DataFrame) -> DataFrame:
    return flat.select("document_id", "country", "text", RATING)


def rated_texts(flat: DataFrame) -> DataFrame:
    """The projection behind the panels, rating under the name ``success``."""
    return flat.select(
        "document_id", "country", F.col(RATING).alias("success"), "text", "number_of_reviews"
    )


def country_counts(flat: DataFrame) -> DataFrame:
    return flat.groupBy("country").agg(F.count(F.lit(1)).alias("count"))


def market_slice(flat: DataFrame, country: str) -> DataFrame:
    return flat.where(F.col("country") == F.lit(country))


def in_countries(flat: DataFrame, countries: Iterable[str]) -> DataFrame:
    return flat.where(F.col("country").isin(*countries))


def at_least_rated(flat: DataFrame, rating: int, column: str = RATING) -> DataFrame:
    """Inclusive; a missing rating never qualifies."""
    return flat.where(F.col(column) >= F.lit(rating))


def more_reviews_than(flat: DataFrame, reviews: int) -> DataFrame:
    return flat.where(F.col("number_of_reviews") > F.lit(reviews))


def with_text(flat: DataFrame, text: str = "text") -> DataFrame:
    return flat.where(F.col(text).isNotNull())


def high_rated(
    flat: DataFrame, min_rating: int = 99, min_reviews: int = 5, column: str = RATING
) -> DataFrame:
    """Strictly above both bounds."""
    return more_reviews_than(flat.where(F.col(column) > F.lit(min_rating)), min_reviews)


def find_by_rooms_and_price(flat: DataFrame, bedrooms: int = 2, above: float = 50) -> DataFrame:
    return flat.where((F.col("bedrooms") == F.lit(bedrooms)) & (F.col("price") > F.lit(above)))


def average_price(flat: DataFrame, by: str = "room_type") -> DataFrame:
    return flat.groupBy(by).agg(F.avg("price").alias("avg_price"))


def map_points(flat: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Longitude and latitude; rows that lack either are left out."""
    return flat.select(
        *keep,
        F.get("coordinates", F.lit(0)).alias("longitude"),
        F.get("coordinates", F.lit(1)).alias("latitude"),
    ).dropna(subset=["longitude", "latitude"])
