"""Stop words and sentiment lexicons.

Lexicons are tables the user brings: ``(word, value)`` for signed scores, ``(word, sentiment)`` for
classes, where a word may have several rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CLASS_LEXICON, SCORE_LEXICON


def word_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small table whose exact size the optimizer knows."""
    types = {"string": pa.string(), "int": pa.int32()}
    columns = {
        field.name: pa.array([row[i] for row in rows], types[field.dataType.simpleString()])
        for i, field in enumerate(schema.fields)
    }
    return spark.createDataFrame(pa.table(columns), schema=schema)


def default_stop_words(spark: SparkSession, language: str = "english") -> DataFrame:
    words = StopWordsRemover.loadDefaultStopWords(language)
    schema = T.StructType([T.StructField("word", T.StringType())])
    return word_table(spark, [(w,) for w in words], schema)


def read_stop_words(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Any table with a ``word`` column; stacked lists with repeated words are fine."""
    loaded = load_words(spark, path, fmt)
    return loaded.select(F.col("word").cast("string")).where("word is not null").distinct()


def read_score_lexicon(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _typed(load_words(spark, path, fmt), SCORE_LEXICON)


def read_class_lexicon(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _typed(load_words(spark, path, fmt), CLASS_LEXICON)


def load_words(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", True).csv(path)
    return spark.read.format(fmt).load(path)


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"lexicon lacks column(s) {missing}; it has {df.columns}")
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*columns).dropna()
