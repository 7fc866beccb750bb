"""Quality by compression.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad.
A text is compressed with both, in blocks so that a long text does not outgrow the dictionaries; the
difference of the two sizes, divided by their sum, is its raw value, and a logistic curve fitted on
other labelled texts turns that into the probability of label 1.

The labelled sample is bounded: ``PER_CLASS`` texts of each label and ``SAMPLE_BYTES`` bytes.  One
half of it builds the dictionaries, the other half fits the curve.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelex.llm.common import crc_mod

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PER_CLASS = 800
SAMPLE_BYTES = 48 << 20
#: No text takes more than this part of its class's half of the bytes.
PARTS = 8
DICTIONARY_BYTES = 112 << 10
BLOCK = 4096
LEVEL = 3
#: Scores of at least this much count as label 1.
THRESHOLD = 0.3


def blocks(raw: bytes) -> list[bytes]:
    """The whole text in blocks; a short last block joins the one before."""
    ends = list(range(BLOCK, len(raw) - BLOCK // 2, BLOCK))
    return [raw[a:b] for a, b in zip([0, *ends], [*ends, len(raw)], strict=True)]


def build_dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or where there is too little to train on, the end of the texts as such."""
    parts = [p for t in texts for p in blocks(t) if p]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[-DICTIONARY_BYTES:]


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = []
        for data in (good, bad):
            shared = zstandard.ZstdCompressionDict(data) if data else None
            if shared is not None:
                shared.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=shared, write_content_size=False, write_dict_id=False
                )
            )

    def value(self, raw: bytes) -> float:
        """Positive where the good dictionary compresses better; between -1 and 1."""
        good, bad = (sum(len(c.compress(p)) for p in blocks(raw)) for c in self.compressors)
        return (bad - good) / max(1, bad + good)


class Model:
    def __init__(self, good: list[bytes], bad: list[bytes]):
        """``good`` and ``bad``: sampled texts in a fixed order."""
        self.good, self.bad = build_dictionary(good[::2]), build_dictionary(bad[::2])
        sizes = Sizes(self.good, self.bad)
        values = [sizes.value(t) for t in good[1::2] + bad[1::2]]
        signs = [1.0] * len(good[1::2]) + [0.0] * len(bad[1::2])
        self.prior = (len(good) + 1) / (len(good) + len(bad) + 2)
        self.slope, self.offset = calibrate(np.array(values), np.array(signs))


def calibrate(values: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """A logistic curve by Newton steps, each class with the same total weight, softened labels."""
    n_good, n_bad = labels.sum(), len(labels) - labels.sum()
    if not n_good or not n_bad:
        return 0.0, 0.0
    aim = np.where(labels > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    share = np.where(labels > 0, 0.5 / n_good, 0.5 / n_bad) * len(labels)
    scale = float(np.abs(values).mean()) or 1.0
    x = np.stack([values / scale, np.ones(len(values))], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (share * (p - aim)) + 1e-3 * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w -= np.clip(np.linalg.solve(curve, slope), -5, 5)
    return float(w[0] / scale), float(w[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = PER_CLASS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model | None:
    """Learn from a bounded sample of labelled rows whose crc32 of the id, modulo 5, is not 0.

    ``None`` where no such row has both a label and a text.  Rows with several labels count as bad
    if one of them is 0.  Drawn are different texts, those whose hashes are lowest: copies and
    repeated rows count once in a class.  Each class has half of ``sample_bytes``, and of a text
    longer than ``1 / PARTS`` of that only so much is learnt from, so that no text shuts out others.
    """
    share = sample_bytes // 2
    longest = max(1, share // PARTS)
    marks = (
        labels.where(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1))
        .where(crc_mod(id_col, 5) != 0)
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min("quality").alias("mark"))
    )
    filled = docs.where(F.length(text_col) > 0).select(
        F.col(id_col).alias("doc"), F.col(text_col).alias("text")
    )
    drawn = filled.select("doc", F.xxhash64("text").alias("draw"), F.octet_length("text").alias("size"))
    contents = (
        drawn.join(marks, F.col("doc") == F.col("id"))
        .groupBy("mark", "draw", "size").agg(F.min("doc").alias("doc"))
    )
    # The lowest draws of a class are found by every task before any two meet.
    lowest = [
        contents.where(F.col("mark") == mark).orderBy("draw", "size").limit(per_class)
        for mark in (0, 1)
    ]
    wanted, used = [], {0: 0, 1: 0}
    for row in lowest[0].unionByName(lowest[1]).collect():
        take = min(row["size"], longest)
        if used[row["mark"]] + take <= max(share, longest):
            used[row["mark"]] += take
            wanted.append((str(row["doc"]), row["draw"], row["mark"], take))
    if not wanted:
        return None
    sample = docs.sparkSession.createDataFrame(wanted, "id string, draw long, mark int, take int")
    texts = (
        filled.join(
            F.broadcast(sample),  # at most 2 * per_class rows
            (F.col("doc").cast("string") == F.col("id")) & (F.xxhash64("text") == F.col("draw")),
        )
        .select("mark", "draw", F.substring(F.col("text").cast("binary"), F.lit(1), F.col("take")).alias("raw"))
        .dropDuplicates(["mark", "draw"])
    )
    return from_sample([(r["mark"], bytes(r["raw"])) for r in texts.collect()])


def from_sample(found: list[tuple[int, bytes]]) -> Model | None:
    found = sorted(found, key=lambda r: (r[0], len(r[1]), r[1]))
    texts = {mark: [t for m, t in found if m == mark] for mark in (0, 1)}
    return Model(texts[1], texts[0]) if found else None


def score(
    docs: DataFrame,
    model: Model | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: doc_id, score (0 to 1, higher: label 1 likelier), predicted (0 or 1).

    Null and empty texts have no difference of sizes: their score is the share of label 1 in the
    sample.  Without a model every score is 0.5.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches):
        machine = model
        sizes = Sizes(machine.good, machine.bad) if machine else None
        for batch in batches:
            scores = []
            for raw in batch.column("raw"):
                data = raw.as_buffer().to_pybytes() if raw.is_valid else b""
                if machine is None:
                    scores.append(0.5)
                elif not data:
                    scores.append(machine.prior)
                else:
                    x = machine.slope * sizes.value(data) + machine.offset
                    scores.append(float(1 / (1 + np.exp(-min(40.0, max(-40.0, x))))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    scored = base.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
