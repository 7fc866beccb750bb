"""Listings and lexicons with what does not parse in a table beside them.

The strict readers stop at the first malformed line.  These return two tables: the rows that parse,
and one row ``file, reason, line`` for each that does not.  Both are lazy reads of the same files.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CLASS_LEXICON, SCORE_LEXICON
from .listings import json_schema, plain_number
from .words import load_words

#: Where the JSON parser puts a line that it cannot read.
BROKEN = "_broken"


class Checked(NamedTuple):
    rows: DataFrame
    rejected: DataFrame


def check_listings(
    spark: SparkSession, path: str, key_type: T.DataType = T.LongType()
) -> Checked:
    """JSON lines: ``rows`` as ``read_listings`` returns them, ``rejected`` with ``malformed`` or the
    name of the first field that holds no number.

    Lines are read as text and parsed whole, so that what counts as malformed does not depend on the
    columns a query reads.  Blank lines are no rows.
    """
    fields = T.StructType([*json_schema().fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")
    )
    # A generator, since a filter would be pushed below a projection and have the line parsed twice.
    document = F.explode(F.array(F.from_json("line", fields, options)))
    parsed = lines.where(F.col("line").rlike(r"\S")).select("file", "line", document.alias("d"))

    score = "review_scores.review_scores_rating"
    read = {
        "_id": (F.col("d._id"), F.col("d._id").try_cast(key_type)),
        "price": _number("price", "double"),
        "number_of_reviews": _number("number_of_reviews", "int"),
        "bedrooms": _number("bedrooms", "int"),
        score: _number(score, "int"),
    }
    malformed = (
        ~F.col("line").rlike(r"^\s*\{") | F.col("d").isNull() | F.col(f"d.{BROKEN}").isNotNull()
    )
    reason = F.coalesce(
        F.when(malformed, "malformed"),
        *[F.when(text.isNotNull() & value.isNull(), name) for name, (text, value) in read.items()],
    )
    rating = F.struct(read[score][1].alias("review_scores_rating"))
    columns = {name: value for name, (_, value) in read.items() if name != score} | {
        "review_scores": F.when(F.col("d.review_scores").isNotNull(), rating)
    }
    names = json_schema().fieldNames()
    marked = parsed.withColumn("reason", reason)
    return Checked(
        marked.where("reason is null").select(
            *[columns.get(name, F.col(f"d.{name}")).alias(name) for name in names]
        ),
        marked.where("reason is not null").select("file", "reason", "line"),
    )


def check_score_lexicon(spark: SparkSession, path: str, fmt: str = "parquet") -> Checked:
    return _check_words(load_words(spark, path, fmt), SCORE_LEXICON)


def check_class_lexicon(spark: SparkSession, path: str, fmt: str = "parquet") -> Checked:
    return _check_words(load_words(spark, path, fmt), CLASS_LEXICON)


def _number(field: str, kind: str) -> tuple[Column, Column]:
    text = F.col(f"d.{field}")
    return text, plain_number(text).try_cast("double").try_cast(kind)


def _check_words(loaded: DataFrame, schema: T.StructType) -> Checked:
    """The reason is the first column that is missing, ``no word``, or of another type,
    ``word is no string``; the line is the row as JSON."""
    lacking = [f.name for f in schema.fields if f.name not in loaded.columns]
    if lacking:
        raise ValueError(f"lexicon lacks column(s) {lacking}; it has {loaded.columns}")
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    reason = F.coalesce(
        *[
            F.when(F.col(f.name).isNull(), f"no {f.name}").when(
                typed[f.name].isNull(), f"{f.name} is no {f.dataType.simpleString()}"
            )
            for f in schema.fields
        ]
    )
    line = F.to_json(F.struct(*[F.col(name) for name in loaded.columns]))
    return Checked(
        loaded.where(reason.isNull()).select(*[c.alias(name) for name, c in typed.items()]),
        loaded.where(reason.isNotNull()).select(
            F.col("_metadata.file_path").alias("file"), reason.alias("reason"), line.alias("line")
        ),
    )
