"""Saved tables published together, as one version.

A run writes its tables into a folder of its own and, once all of them stand, one manifest that names
them.  Readers start from the newest manifest: a run that fails or is still under way is never seen,
and no reader mixes the tables of two runs.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.clustering import LocalLDAModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .tables import load_table, load_topic_model

#: Folders of the manifests and of the versions' tables.
MANIFESTS = "manifests"
VERSIONS = "versions"
MANIFEST = "published_at bigint, name string, tables array<string>"


class NotPublished(LookupError):
    """There is no complete version, or the version has no such table."""


@dataclass(frozen=True)
class Version:
    """One complete set of tables.  Whoever holds it reads that set, whatever is published later."""

    name: str
    folder: str
    tables: tuple[str, ...]

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        return load_table(spark, self._holding(table), table)

    def load_topic_model(self, table: str = "topic_model") -> LocalLDAModel:
        return load_topic_model(self._holding(table), table)

    def _holding(self, table: str) -> str:
        if table not in self.tables:
            raise NotPublished(f"version {self.name} has no table {table!r}, only {self.tables}")
        return self.folder


def publish(spark: SparkSession, folder: str, write: Callable[[str], Sequence[str]]) -> Version:
    """Let ``write`` save tables into the folder it is given, then publish the names it returns.

    If ``write`` fails, its error is passed on, the version before stays current, and what was written
    is in a folder that no manifest names.  Runs may overlap, since each has folders of its own; the
    one that publishes last is current.  Earlier versions are kept for those who still read them.
    """
    name = uuid.uuid4().hex
    target = f"{folder}/{VERSIONS}/{name}"
    tables = tuple(write(target))
    newest = _newest(spark, folder)
    # Clocks of two drivers may differ: never before the version that is replaced.
    moment = max(time.time_ns(), 0 if newest is None else newest.published_at + 1)
    manifest = spark.createDataFrame([(moment, name, list(tables))], MANIFEST)
    # One row in one file, which is either there or not.
    manifest.coalesce(1).write.parquet(f"{folder}/{MANIFESTS}/{name}")
    return Version(name, target, tables)


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """``published_at, name, tables`` of every complete version; ``published_at`` in nanoseconds."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{folder}/{MANIFESTS}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def current(spark: SparkSession, folder: str) -> Version:
    """The version that was published last."""
    newest = _newest(spark, folder)
    if newest is None:
        raise NotPublished(f"nothing is published in {folder}")
    return Version(newest.name, f"{folder}/{VERSIONS}/{newest.name}", tuple(newest.tables))


def _newest(spark: SparkSession, folder: str) -> Row | None:
    return manifests(spark, folder).orderBy(F.desc("published_at"), F.desc("name")).first()
