"""Connected components of a table of links, by alternating large and small stars.

Every round replaces links by links to the smallest neighbour (R. Kiveris and others, "Connected
components in MapReduce and beyond", 2014).  A round is two aggregates and two joins; its links are
written to the checkpoint folder, so lineage does not grow.  Hubs meet their links in a join that the
engine can split; no list of neighbours is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelex.llm.common import saved


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node point to its smallest neighbour or itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    low = F.least("low", "node")
    moved = both.where("b > a").join(least, F.col("a") == F.col("node"))
    return moved.select(low.alias("a"), "b").where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them.  ``a < b`` holds in links."""
    least = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
    moved = links.join(least, F.col("b") == F.col("node"))
    pairs = moved.select(
        F.explode(
            F.array(
                F.struct(F.col("low").alias("a"), F.col("a").alias("b")),
                F.struct(F.col("low").alias("a"), F.col("b")),
            )
        ).alias("x")
    ).select("x.*")
    return pairs.where("a != b").distinct()


def _mark(links: DataFrame):
    return links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link; ``component`` is its smallest node.

    ``links`` has two integer columns, a and b; order, repeats and self-links do not matter, rows
    with a null are no links.
    """
    nodes = links.where("a is not null and b is not null")
    ordered = saved(
        nodes.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a != b").distinct(),
        "links",
    )
    mark = _mark(ordered)
    while mark[0]:
        ordered = saved(_small_star(_large_star(ordered)), "links")
        fresh = _mark(ordered)
        if fresh == mark:
            break
        mark = fresh
    roots = ordered.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return ordered.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
