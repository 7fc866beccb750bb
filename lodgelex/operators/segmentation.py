"""Word segmentation of texts without spaces, as a column of tokens that every text operator reads.

The tokeniser leaves a run of ideographs as one token.  Here such runs are cut in dictionary words
along the cheapest path; tokens of other scripts stay as they are, and so does the rest of a mixed
token.  A dictionary of checked size goes to the tasks as a trie and nothing is shuffled.  A larger one
stays a table: the words that a pack of rows may hold are joined with it, and those found decide the runs
of its rows.
"""

from __future__ import annotations

import itertools

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.segmentation import (
    SIEVE_BITS,
    SIEVE_BLOCK,
    UNKNOWN,
    Trie,
    cut_rows,
    different_words,
    marks_of,
    packed,
    packs_of,
    sieve_of,
    unpacked,
)
from ..functions.text import tokens_of

#: Dictionary words that go to the tasks.
DICTIONARY_WORDS = 500_000


def word_costs(dictionary: DataFrame) -> tuple[DataFrame, Column]:
    """``word, cost`` in thousandths of -ln(share), and the cost of an unknown character.

    ``dictionary`` has a column ``word`` and may have positive weights ``n``; without them all words
    weigh the same, so that the path with the fewest words is the cheapest.  Repeated words add up.
    """
    weight = F.col("n").cast("double") if "n" in dictionary.columns else F.lit(1.0)
    summed = (
        dictionary.select("word", weight.alias("n"))
        .where("word is not null and length(word) > 0 and n > 0")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )
    total = summed.agg(F.sum("n").alias("total")).scalar()
    cost = F.round(F.ln((total + 1) / F.col("n")) * 1000).cast("long")
    unknown = F.round(F.ln(F.coalesce(total, F.lit(0.0)) + 1) * 1000).cast("long") + UNKNOWN
    return summed.select("word", cost.alias("cost")), unknown


def segmented(
    listings: DataFrame,
    dictionary: DataFrame,
    text: str = "text",
    name: str = "tokens",
    limit: int = DICTIONARY_WORDS,
) -> DataFrame:
    """``listings`` with the array of its words, in order, in the column ``name``.

    ``text`` is a string or an array of tokens.  ``words``, ``bigrams`` and the panels take the new
    column with ``text="tokens"``.  Null texts have null tokens.  ``limit`` picks between two plans
    with one result.
    """
    costs, unknown = word_costs(dictionary)
    plain = listings.withColumn(name, tokens_of(listings, text))
    few = costs.limit(limit + 1).collect() if limit else []
    if limit and len(few) <= limit:
        (alone,) = listings.sparkSession.range(1).select(unknown).first()
        shared = listings.sparkSession.sparkContext.broadcast([(r.word, r.cost) for r in few])
        return plain.withColumn(name, _by_trie(shared, alone)(F.col(name)))
    return _by_join(plain, costs, unknown, name)


def _by_trie(shared, alone: int):
    tries: list[Trie] = []

    @F.arrow_udf("array<string>")
    def cut(tokens: pa.Array) -> pa.Array:
        if not tries:
            tries.append(Trie(shared.value))
        return cut_rows(tokens, tries[0], alone)

    return cut


def _by_join(plain: DataFrame, costs: DataFrame, unknown: Column, name: str) -> DataFrame:
    """The words that a pack of rows may hold, joined with the dictionary, and its rows cut by them.

    A task packs its rows, compressed and bounded in size.  A sieve of bounded size drops nearly all
    places where no word begins.  So what is dealt out are the different words of a pack, each once
    however many of its rows hold it, and the pack; what meets in one group are the words of one pack.
    """
    spark = plain.sparkSession

    @F.arrow_udf("long")
    def mark(words: pa.Array) -> pa.Array:
        return pa.array(marks_of(words))

    bit = F.pmod(mark("word"), F.lit(SIEVE_BITS))
    block = F.floor(bit / SIEVE_BLOCK)
    blocks = costs.select(
        block.alias("block"), (bit % SIEVE_BLOCK).alias("bit"), F.length("word").alias("size")
    ).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"), F.max("size").alias("longest"))
    # At most SIEVE_BITS bits, however large the dictionary is.
    filled = blocks.collect()
    longest = max((row.longest for row in filled), default=0)
    shared = spark.sparkContext.broadcast([(row.block, bytes(row.bits)) for row in filled])
    # The cost of an unknown character is one number for the whole dictionary.
    (alone,) = spark.range(1).select(unknown).first()

    def deal(batches):
        sieve, task, turn = sieve_of(shared.value), TaskContext.get().partitionId(), itertools.count()
        for batch in batches:
            for rows in packs_of(batch, "_kept"):
                words = different_words(rows.column("_kept"), sieve, longest)
                # The pack goes last, under a key of its own that no other pack shares.
                own = (task << 33) | next(turn)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own] * (len(words) + 1), pa.int64()),
                        pa.concat_arrays([words, pa.array([f"\0{own}"])]),
                        pa.array([None] * len(words) + [packed(rows)], pa.binary()),
                    ],
                    names=["_pack", "word", "_rows"],
                )

    def cut(pack: pa.Table) -> pa.Table:
        found = pack.filter(pc.is_null(pack["_rows"]))
        # A word that a row does not hold changes none of its paths.
        trie = Trie(zip(found["word"].to_pylist(), found["cost"].to_pylist(), strict=True))
        rows = unpacked(pack["_rows"].drop_null()[0].as_buffer())
        tokens = cut_rows(rows["_kept"].combine_chunks(), trie, alone)
        return rows.set_column(rows.column_names.index("_kept"), "_kept", tokens)

    kept = plain.withColumn("_kept", F.filter(name, lambda t: F.length(t) > 0))
    full = kept.withColumn("_kept", F.when(F.size("_kept") > 0, F.col("_kept")))
    # Rows without a token that could be cut stay as they are; those of the others are made anew.
    rows = full.withColumn(name, F.when(F.col("_kept").isNull(), F.col(name)))
    dealt = rows.mapInArrow(deal, "_pack long, word string, _rows binary")
    met = dealt.join(costs, "word", "left").where("_rows is not null or cost is not null")
    made = rows.withColumn("_kept", F.lit(None).cast("array<string>")).schema
    new = met.groupBy("_pack").applyInArrow(cut, made)
    return new.withColumn(name, F.coalesce("_kept", name)).drop("_kept")
