"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document draws an exponential key divided by its quality weight; within a source the documents
in key order are a weighted sample without replacement.  A source first gives all its documents as
often as its target holds its whole size, then the documents of the key order up to the rest.

A source may hold most rows, so its order is never one sort: a key falls in one of ``BUCKETS`` ranges
(the exponential's own distribution function, hence equal shares), sums of ranges give each range's
start, and rows are sorted only inside the one range of a source in which its target is reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgelex.llm.common import WORD

BUCKETS = 1024
SEED = 20_240


def word_count(text: Column | str) -> Column:
    """Number of words; null has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def with_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", name: str = "quality_weight"
) -> DataFrame:
    """Add ``name``: 2 for documents labelled good, 0.5 for bad ones, 1 without a label."""
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__labelled")).agg(
        F.max("quality").alias("__mark")
    )
    weight = F.when(F.col("__mark") > 0, 2.0).when(F.col("__mark") <= 0, 0.5).otherwise(1.0)
    joined = docs.join(marks, F.col(id_col) == F.col("__labelled"), "left")
    return joined.withColumn(name, weight).drop("__labelled", "__mark")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1)) -> DataFrame:
    """Weights dealt in turn to the sources by code point, null last.  One row per source."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(values, (turn % len(weights)).cast("int")))


def targets(sources: DataFrame, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Add ``target``: ``share`` of all sizes by weight, never above ``limit`` times a source's size.

    Excess is shared again by weight until none is above.  That ends at min(limit * size, level *
    weight) for one common level, found by prefix sums over the sources in the order in which they
    fill up.  ``sources`` has one row per source: source, source_size, weight.
    """
    cap, ratio = F.col("source_size") * limit, F.col("source_size") * limit / F.col("weight")
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = sources.select("*", cap.alias("cap"), ratio.alias("ratio")).select(
        "*",
        (F.sum("source_size").over(everything) * share).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("filled"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .alias("open_weight"),
    )
    level = (F.col("total") - F.col("filled")) / F.col("open_weight")
    found = ranked.select("*", F.when(level <= F.col("ratio"), level).alias("level"))
    settled = found.select("*", F.max("level").over(everything).alias("settled"))
    target = F.least(F.col("cap"), F.coalesce("settled", F.lit(float("inf"))) * F.col("weight"))
    return settled.select("source", "source_size", "weight", target.alias("target"))


def drawn(id_col: str, size: Column, content_col: str | None = None, seed: int = SEED) -> Column:
    """A number between 0 and 1 for every row, from its id, its size and its content."""
    seen = [F.col(id_col), F.coalesce(size.cast("long"), F.lit(0))]
    seen += [] if content_col is None else [F.col(content_col)]
    return (F.xxhash64(*seen, F.lit(seed)).bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)


def mix(
    docs: DataFrame,
    weights=cyclic_weights,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str | None = None,
    quality_col: str | None = None,
    share: float = 1.5,
    limit: float = 2.0,
    seed: int = SEED,
    content_col: str | None = None,
    carry: tuple[str, ...] = (),
    draw_col: str | None = None,
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken, and ``carry`` in the struct ``row``.

    ``weights`` adds the column ``weight`` to a table of sources.  ``size_col`` holds sizes; without
    it the words of ``text`` are counted.  ``quality_col`` holds positive weights; null counts as 1.
    ``taken`` is a multiple of the size: whole documents only, the one that crosses the rest of the
    target goes where the sum is nearer.  Null sources are one source.  Documents without words
    have size 0 and are taken 0 times.  Keys come from the id, the size and ``content_col``, so
    reruns agree and rows that share an id or have none draw apart where their contents differ;
    equal keys keep the order of (id, size), and rows equal in id, size and content fall on the same
    side of the cut.  ``draw_col`` holds what ``drawn`` gives, made where the contents were at hand: rows
    that are joined with their weights then take no content along for the sums of the ranges.

    Rows stay where they are: a source's cut is found from the sums of its ranges and the rows of the
    one range in which it lies, and comes back as one row per source.
    """
    size = word_count("text") if size_col is None else F.col(size_col).cast("long")
    quality = F.lit(1.0) if quality_col is None else F.coalesce(quality_col, F.lit(1.0))
    size = F.coalesce(size, F.lit(0))
    draw = drawn(id_col, size, content_col, seed) if draw_col is None else F.col(draw_col)
    key = -F.log(draw) / quality
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        size.alias("size"),
        key.alias("key"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    ).withColumn("bucket", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * BUCKETS).cast("int"))

    sums = base.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = (
        targets(weights(sources), share, limit)
        .withColumn("epochs", full.otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumnRenamed("source", "s")
    )
    starts = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(starts), F.lit(0)))
    crossing = (
        offsets.join(plan, F.col("source").eqNullSafe(F.col("s")))
        .where((F.col("start") < F.col("rest")) & (F.col("start") + F.col("bucket_size") >= F.col("rest")))
        .select("s", F.col("bucket").alias("b"), "start", "rest")
    )
    # Of every source the rows of one range, about a thousandth of them.
    near = base.select("doc_id", "source", "size", "key", "bucket").join(
        F.broadcast(crossing), F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    )
    inside = Window.partitionBy("s").orderBy("key", "doc_id", "size")
    middle = F.col("start") + F.sum("size").over(inside) - F.col("size") / 2.0
    last = F.max(F.when(F.col("below"), F.struct("key", "doc_id", "size"))).alias("last")
    cuts = near.withColumn("below", middle <= F.col("rest")).groupBy("s", "b").agg(last)
    marks = plan.join(
        cuts.withColumnsRenamed({"s": "c"}), F.col("s").eqNullSafe(F.col("c")), "left"
    ).drop("c")
    before = (F.col("bucket") < F.col("b")) | (
        (F.col("bucket") == F.col("b")) & (F.struct("key", "doc_id", "size") <= F.col("last"))
    )
    chosen = F.when(F.col("b").isNotNull() & F.coalesce(before, F.lit(False)), F.col("size"))
    # One row per source, as in the window that found the targets: no row is dealt out for it.
    joined = base.join(F.broadcast(marks), F.col("source").eqNullSafe(F.col("s")))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.coalesce(chosen, F.lit(0))).cast("long").alias("taken"),
        *(["row"] if carry else []),
    )


def mixture(docs: DataFrame, carry: tuple[str, ...] | None = None, **options) -> DataFrame:
    """The mixed rows themselves, each as often as it is taken, with the columns ``carry`` (all)."""
    rows = mix(docs, carry=tuple(docs.columns) if carry is None else carry, **options)
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return rows.select(F.explode(F.array_repeat("row", times)).alias("row")).select("row.*")
