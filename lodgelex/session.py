"""Session settings and the places where a plan has to be cut or sized."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings the jobs are written for.  Partition counts are left to the cluster: AQE merges small
#: shuffle partitions up to the advisory size and splits skewed ones.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

#: A side is broadcast only when the optimizer's size estimate stays under this.
BROADCAST_BYTES = 64 * 1024 * 1024

#: Word lists up to this many rows become a literal set inside the generated code.
LITERAL_WORDS = 10_000

#: Only scans below this size are redistributed, whatever the cluster is.
SPREAD_BYTES = 256 * 1024 * 1024


def local_session(cores: int | str = "*", app: str = "lodgelex", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate for ``df``; ``None`` where the session cannot tell."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except (AttributeError, TypeError):
        return None


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def spread(df: DataFrame, key: str) -> DataFrame:
    """Redistribute a small scan that is split too little, leave every other scan alone.

    A file with a single row group is read by one task however many cores there are.  The hash on
    ``key`` is repeatable, so a recomputed task sees the same rows.  Only the layout changes, and no
    result depends on it.
    """
    size = estimated_bytes(df)
    if size is None:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if size > SPREAD_BYTES or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, F.col(key))


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster, else one below the warehouse, which is shared too."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/lodgelex-scratch"
    if folder is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder below the cluster's shared one, for tables that outlive a query."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_folder(spark)
    return f"{base.rstrip('/')}/{name}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once for the repeated passes of an iterative job, in the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
