"""Derived tables: saved once, read back by the panels."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import LocalLDAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of the saved schemas, beside the tables.
SCHEMAS = "schemas"

#: A file is read by as many tasks as it has row groups.  The default of 128 MB leaves a whole market to one
#: task, and every table that is made from it.
ROW_GROUP_BYTES = 4 * 1024 * 1024


def save_table(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = ()) -> str:
    """Write one table as Parquet.

    A partitioned table is rebalanced on its partition columns first: every partition gets files of
    the advisory size, small ones are merged and a partition that holds a third of all rows is split
    over many tasks.  Row groups are small, so that few files are still read by many tasks.
    """
    path = f"{folder}/{name}"
    grouped = {"parquet.block.size": str(ROW_GROUP_BYTES)}
    if partition_by:
        balanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
        balanced.write.options(**grouped).mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.options(**grouped).mode("overwrite").parquet(path)
    schema = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
    schema.coalesce(1).write.mode("overwrite").text(f"{folder}/{SCHEMAS}/{name}")
    return path


def save_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    return {name: save_table(df, folder, name) for name, df in tables.items()}


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table with the schema it was saved with: the country ``007`` stays a text."""
    (row,) = spark.read.text(f"{folder}/{SCHEMAS}/{name}").collect()
    schema = T.StructType.fromJson(json.loads(row.value))
    return spark.read.schema(schema).parquet(f"{folder}/{name}")


def load_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: load_table(spark, folder, name) for name in names}


def save_topic_model(model: LocalLDAModel, folder: str, name: str = "topic_model") -> str:
    path = f"{folder}/{name}"
    model.write().overwrite().save(path)
    return path


def load_topic_model(folder: str, name: str = "topic_model") -> LocalLDAModel:
    return LocalLDAModel.load(f"{folder}/{name}")
