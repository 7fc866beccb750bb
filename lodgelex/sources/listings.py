"""Listing collections: JSON lines or Parquet, always with the declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LISTING_SCHEMA


def read_listings(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    price_type: T.DataType = T.DoubleType(),
    key_type: T.DataType = T.LongType(),
) -> DataFrame:
    """The whole collection.  No inference pass is made; fields outside the schema are not read.

    ``price_type`` is the type that Parquet and ORC files hold, such as ``DecimalType(10, 2)``; prices
    are doubles in the result.  ``key_type`` is the type of ``_id``, text or whole number.  JSON may
    write any number as text, with a decimal part or with currency signs.  What does not parse is an
    error, never a null: malformed lines and numbers stop the job when they are read.
    """
    if fmt not in ("parquet", "json", "orc"):
        raise ValueError(f"listings are read from parquet, json or orc, not {fmt!r}")
    if fmt == "json":
        return _read_json(spark, path, key_type)
    held = {"price": price_type, "_id": key_type}
    stored = T.StructType(
        [T.StructField(f.name, held.get(f.name, f.dataType)) for f in LISTING_SCHEMA.fields]
    )
    loaded = spark.read.schema(stored).format(fmt).load(path)
    if price_type == T.DoubleType():
        return loaded
    return loaded.withColumn("price", F.col("price").cast("double"))


def json_schema() -> T.StructType:
    """What a JSON line holds: every number as the text that stands in the file."""
    as_text = {"_id", "price", "number_of_reviews", "bedrooms"}
    rating = T.StructType([T.StructField("review_scores_rating", T.StringType())])
    held = {name: T.StringType() for name in as_text} | {"review_scores": rating}
    return T.StructType(
        [T.StructField(f.name, held.get(f.name, f.dataType)) for f in LISTING_SCHEMA.fields]
    )


def _read_json(spark: SparkSession, path: str, key_type: T.DataType) -> DataFrame:
    """Numbers are cast, with an error for junk."""
    loaded = spark.read.schema(json_schema()).option("mode", "FAILFAST").json(path)
    score = F.col("review_scores.review_scores_rating")
    return loaded.withColumns(
        {
            "_id": F.col("_id").cast(key_type),
            "price": _number(F.col("price")),
            "number_of_reviews": _number(F.col("number_of_reviews")).cast("int"),
            "bedrooms": _number(F.col("bedrooms")).cast("int"),
            "review_scores": F.when(
                F.col("review_scores").isNotNull(),
                F.struct(_number(score).cast("int").alias("review_scores_rating")),
            ),
        }
    )


def plain_number(text: Column) -> Column:
    """The text of a number without currency signs and separators of thousands."""
    return F.trim(F.regexp_replace(text, "[$,]", ""))


def _number(text: Column) -> Column:
    """A number written as text; null stays null, anything else that is no number is an error."""
    plain = plain_number(text)
    value = plain.try_cast("double")
    junk = F.raise_error(F.concat(F.lit("not a number: "), plain)).cast("double")
    return F.when(plain.isNotNull() & value.isNull(), junk).otherwise(value)


def listings_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The ``documents`` table in listing shape: language as country, source as market.

    A summary is the whole text, a description the text with its source behind it.  Ratings,
    reviews, rooms and coordinates are arithmetic on ``doc_id`` and ``n_chars``.
    """
    return spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "doc_id as _id",
        "text as summary",
        "text || ' ' || source as description",
        """named_struct(
             'country', lang,
             'market', source,
             'location', named_struct('coordinates', array(
               case when doc_id % 11 = 0 then null
                    else cast((doc_id * 37) % 360 - 180 as double) end,
               case when doc_id % 17 = 0 then null
                    else cast((doc_id * 53) % 180 - 90 as double) end))) as address""",
        """named_struct('review_scores_rating',
             case when doc_id % 13 = 0 then null
                  else cast(least(100, 20 + (doc_id * 7) % 101) as int) end) as review_scores""",
        "cast(n_chars % 20 as int) as number_of_reviews",
        "cast(doc_id % 4 as int) as bedrooms",
        "cast(20 + doc_id % 200 as double) as price",
        """case doc_id % 3 when 0 then 'Entire home/apt'
                           when 1 then 'Private room' else 'Shared room' end as room_type""",
    )
