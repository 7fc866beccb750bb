"""Bigrams as a directed graph: an edge table and a node table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bigram_edges(
    counts: DataFrame, by: Sequence[str] = ("country",), more_than: int | None = None
) -> DataFrame:
    """``by..., src, dst, n, width``; ``more_than`` keeps the bigrams counted above it."""
    kept = counts if more_than is None else counts.where(F.col("n") > F.lit(more_than))
    return kept.select(
        *by,
        F.col("word1").alias("src"),
        F.col("word2").alias("dst"),
        "n",
        F.sqrt("n").alias("width"),
    )


def bigram_nodes(edges: DataFrame, by: Sequence[str] = ("country",)) -> DataFrame:
    """Every word at either end of an edge, once per slice; the edges are read once."""
    ends = F.explode(F.array("src", "dst")).alias("name")
    return edges.select(*by, ends).distinct()
