"""Small word lists of our own for trying the operators out on the test tables.

The test tables hold invented text, so the words are some that do occur in it.  Repeated words and
words with several classes are deliberate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import CLASS_LEXICON, SCORE_LEXICON
from .words import word_table

# Fixed values.
AFINN_ROWS = [
    ("scum", -4), ("idiot", -3), ("trash", -2), ("worthless", -2), ("pathetic", -2), ("best", 3),
    ("with", 1),
]
BING_ROWS = [
    ("scum", "negative"), ("idiot", "negative"), ("trash", "negative"), ("best", "positive"),
    ("with", "positive"), ("clown", "negative"), ("clown", "positive"),
]
NRC_ROWS = [
    ("scum", "negative"), ("scum", "anger"), ("idiot", "negative"), ("idiot", "disgust"),
    ("best", "positive"), ("best", "joy"), ("for", "trust"), ("with", "positive"),
    ("moron", "negative"),
]
STOP_ROWS = [("of",), ("a",), ("to",), ("in",), ("of",)]


def sample_afinn(spark: SparkSession) -> DataFrame:
    return word_table(spark, AFINN_ROWS, SCORE_LEXICON)


def sample_bing(spark: SparkSession) -> DataFrame:
    return word_table(spark, BING_ROWS, CLASS_LEXICON)


def sample_nrc(spark: SparkSession) -> DataFrame:
    return word_table(spark, NRC_ROWS, CLASS_LEXICON)


def sample_stop_words(spark: SparkSession) -> DataFrame:
    return word_table(spark, STOP_ROWS, T.StructType([T.StructField("word", T.StringType())]))
