"""Language identification by hierarchical discrimination.

First the language family is decided, then the language inside it; each decision among several is a
vote of one-versus-one linear support vector machines.  The features of a text are the shares of its
byte trigrams, hashed into ``BUCKETS``, over letters in lower case with everything else as a blank.
A linear machine's margin is then a sum over the text, so whole texts are scored in one pass over
their bytes however long they are.

The machines are fitted on the driver by dual coordinate descent, on at most ``PER_LANGUAGE`` different
texts of each language, ``SAMPLE_ROWS`` texts and ``SAMPLE_BYTES`` bytes in all.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgelex.llm.common import bytes_of, crc_mod, giving_back, thinned

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 16
PER_LANGUAGE = 400
SAMPLE_BYTES = 32 << 20
SAMPLE_ROWS = 204_800
#: No text takes more than this part of its language's share of the bytes.
PARTS = 8
UNKNOWN = "und"
#: A label gives way to another language only above this score.
SURE = 0.5
#: Bytes that a task scores together.
TOGETHER = 1 << 20

# Families of languages by ISO 639-1 code.  Others are families of their own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("hi", "bn", "mr", "ur", "pa", "gu", "ne"),
}
FAMILY_OF = {language: family for family, members in FAMILIES.items() for language in members}


def _letters() -> np.ndarray:
    table = np.full(256, 0x20, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    for low in range(ord("a"), ord("z") + 1):
        table[low] = table[low - 32] = low
    return table


LETTERS = _letters()


def trigram_buckets(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bucket of the trigram at each byte; BUCKETS (no weight) where none begins.

    A trigram lies inside one text and is not blank in its middle and next to it.
    """
    n = len(raw)
    out = np.full(n, BUCKETS, np.int32)
    if n < 3:
        return out
    c = LETTERS[raw]
    a, b, d = c[:-2].astype(np.uint32), c[1:-1].astype(np.uint32), c[2:].astype(np.uint32)
    code = ((a << np.uint32(16)) | (b << np.uint32(8)) | d) * np.uint32(0x9E3779B1)
    out[:-2] = code >> np.uint32(16)
    blank = c == 0x20
    out[:-2][blank[1:-1] & (blank[:-2] | blank[2:])] = BUCKETS
    ends = offsets[1:]
    for back in (1, 2):
        at = ends - back
        out[at[at >= 0]] = BUCKETS
    return out


def shares(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's features: buckets and the square roots of their shares; their squares sum to 1."""
    data = np.frombuffer(raw, np.uint8)
    found = trigram_buckets(data, np.array([0, len(data)]))
    at, n = np.unique(found[found < BUCKETS], return_counts=True)
    total = max(1, int(n.sum()))
    return at, n / total


def fit_machine(samples, signs: np.ndarray, rounds: int = 12, cost: float = 100.0) -> np.ndarray:
    """Weights of a linear machine (the last is the bias) by dual coordinate descent, squared hinge.

    The order of visits is a fixed permutation each round, so equal samples give equal weights.
    """
    weights = np.zeros(BUCKETS + 1)
    alpha = np.zeros(len(samples))
    norms = np.array([float((v * v).sum()) + 1e-4 for _, v in samples]) + 0.5 / cost
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(samples)):
            at, value = samples[i]
            y = signs[i]
            margin = y * (float(weights[at] @ value) + 0.01 * weights[BUCKETS])
            step = (1 - margin - 0.5 * alpha[i] / cost) / norms[i]
            fresh = max(0.0, alpha[i] + step)
            if fresh != alpha[i]:
                weights[at] += (fresh - alpha[i]) * y * value
                weights[BUCKETS] += (fresh - alpha[i]) * y * 0.01
                alpha[i] = fresh
    return weights


class Model:
    """Machines of the families and, inside each family, of its languages."""

    def __init__(self, samples: list[tuple[str, bytes]]):
        self.languages = sorted({language for language, _ in samples})
        self.families = {}
        for language in self.languages:
            self.families.setdefault(FAMILY_OF.get(language, language), []).append(language)
        self.names = sorted(self.families)
        features = [shares(raw) for _, raw in samples]
        spoken = np.array([language for language, _ in samples])
        family = np.array([FAMILY_OF.get(s, s) for s in spoken])
        self.machines: list[np.ndarray] = []
        self.slopes: list[float] = []
        self.family_pairs = self._fit(self.names, family, features)
        self.pairs = {f: self._fit(self.families[f], spoken, features) for f in self.names}
        # One row of weights per bucket, a last row of zeros for bytes where no trigram begins.
        stacked = np.zeros((BUCKETS + 1, max(1, len(self.machines))), np.float32)
        bias = np.zeros(max(1, len(self.machines)))
        for k, machine in enumerate(self.machines):
            stacked[:BUCKETS, k] = machine[:BUCKETS]
            bias[k] = 0.01 * machine[BUCKETS]
        self.weights, self.bias = np.ascontiguousarray(stacked.T), bias
        self.count = len(self.machines)
        del self.machines

    def _fit(self, names: list[str], labels: np.ndarray, features) -> list[tuple[int, int, int]]:
        found = []
        for a, b in combinations(range(len(names)), 2):
            rows = np.flatnonzero((labels == names[a]) | (labels == names[b]))
            signs = np.where(labels[rows] == names[a], 1.0, -1.0)
            machine = fit_machine([features[r] for r in rows], signs)
            margins = [
                s * (machine[features[r][0]] @ features[r][1] + 0.01 * machine[BUCKETS])
                for r, s in zip(rows, signs, strict=True)
            ]
            found.append((a, b, len(self.machines)))
            self.machines.append(machine)
            # Margins become probabilities on the scale of the fitted texts.
            self.slopes.append(3.0 / max(1e-6, float(np.median(margins))))
        return found

    def margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row per text, a column per machine."""
        rows = len(offsets) - 1
        out = np.tile(self.bias, (rows, 1))
        full = np.flatnonzero(np.diff(offsets) > 0)
        if not len(full):
            return out
        bucket = trigram_buckets(raw, offsets)
        starts = offsets[:-1][full]
        total = np.maximum(1, np.add.reduceat((bucket < BUCKETS).astype(np.int64), starts))
        for k in range(self.count):
            sums = np.add.reduceat(self.weights[k][bucket], starts, dtype=np.float64)
            out[full, k] += sums / total
        return out

    def _vote(self, margins: np.ndarray, pairs, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The winner and its probability: votes first, summed probabilities decide ties."""
        votes = np.zeros((len(margins), count))
        for a, b, k in pairs:
            for_a = 1 / (1 + np.exp(-np.clip(margins[:, k] * self.slopes[k], -60, 60)))
            votes[:, a] += (for_a >= 0.5) + for_a / (count + 1)
            votes[:, b] += (for_a < 0.5) + (1 - for_a) / (count + 1)
        winner = votes.argmax(1)
        sure = np.ones(len(margins))
        for a, b, k in pairs:
            for_a = 1 / (1 + np.exp(-np.clip(margins[:, k] * self.slopes[k], -60, 60)))
            sure = np.where(winner == a, np.minimum(sure, for_a), sure)
            sure = np.where(winner == b, np.minimum(sure, 1 - for_a), sure)
        return winner, sure

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of every text."""
        margins = self.margins(raw, offsets)
        family, sure = self._vote(margins, self.family_pairs, len(self.names))
        language = np.empty(len(margins), object)
        for f, name in enumerate(self.names):
            rows = np.flatnonzero(family == f)
            members = self.families[name]
            winner, inner = self._vote(margins[rows], self.pairs[name], len(members))
            language[rows] = np.array(members, object)[winner]
            sure[rows] *= inner
        return language, sure


def training_rows(docs: DataFrame, id_col: str, lang_col: str) -> Column:
    return F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (crc_mod(id_col, 3) != 1)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    sample_bytes: int = SAMPLE_BYTES,
    sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """Fit on a bounded sample of the rows that may be learnt from; ``None`` without such a row.

    The sample is the ``per_language`` different texts of each language whose hashes are lowest
    (fewer of each where there are so many languages that ``sample_rows`` would be passed), then as
    many of them, taken in that order, as fit into the language's share of ``sample_bytes``; what
    others leave of theirs is filled afterwards.  Copies and repeated rows count once, so they shut
    out no other text.  Of a text longer than ``1 / PARTS`` of a share only so much is learnt from.
    """
    usable = docs.where(training_rows(docs, id_col, lang_col) & has_letters(text_col)).select(
        F.col(id_col).cast("string").alias("id"),
        F.col(lang_col).alias("lang"),
        F.xxhash64(F.col(text_col)).alias("draw"),
        F.octet_length(text_col).alias("size"),
    )
    few, take = thinned(usable, "lang", "draw", per_language, sample_rows)
    contents = few.groupBy("lang", "draw", "size").agg(F.min("id").alias("id"))
    order = Window.partitionBy("lang").orderBy("draw", "size")
    sample = (
        contents.withColumn("turn", F.row_number().over(order))
        .where(F.col("turn") <= take)
        .orderBy("turn", "lang")
        .collect()
    )
    if not sample:
        return None
    share = sample_bytes // len({row["lang"] for row in sample})
    longest = max(1, share // PARTS)
    ids, later, used = [], [], {}
    for row in sample:
        part = (row["id"], row["lang"], row["draw"], min(row["size"], longest))
        if used.get(row["lang"], 0) + part[3] <= max(share, longest):
            used[row["lang"]] = used.get(row["lang"], 0) + part[3]
            ids.append(part)
        else:
            later.append(part)
    total = sum(used.values())
    for part in later:
        if total + part[3] <= sample_bytes:
            total += part[3]
            ids.append(part)
    spark = docs.sparkSession
    wanted = spark.createDataFrame(ids, "id string, lang_of string, draw long, take int")
    read = docs.select(
        F.col(id_col).cast("string").alias("doc"),
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
    )
    texts = read.join(
        F.broadcast(wanted),  # at most sample_rows rows
        (F.col("doc") == F.col("id"))
        & (F.col("lang") == F.col("lang_of"))
        & (F.xxhash64("text") == F.col("draw")),
    ).select(
        "lang", "draw",
        F.substring(F.col("text").cast("binary"), F.lit(1), F.col("take")).alias("raw"),
    )
    rows = texts.dropDuplicates(["lang", "draw"]).collect()
    rows.sort(key=lambda r: (r["lang"], r["draw"]))
    return Model([(r["lang"], bytes(r["raw"])) for r in rows])


def has_letters(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def identify(
    docs: DataFrame,
    model: Model | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, lang_pred, score (0 to 1), and ``carry`` in the struct ``row``.

    Only the text is looked at, the whole of it.  Null texts and texts without a letter are ``und``
    with score 0, and so is everything where there was nothing to learn from.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(has_letters(text_col), F.col(text_col)).cast("binary").alias("raw"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    )
    kept = [f for f in base.schema.fields if f.name != "raw"]
    names = [f.name for f in kept]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                language, sure = predicted(model, batch.column("raw"))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), language, sure],
                    names=[*names, "lang_pred", "score"],
                )

    return base.mapInArrow(giving_back(score), f"{ddl}, lang_pred string, score double")


def predicted(model: Model | None, column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Language and score of every text (bytes); null texts are ``und`` with score 0."""
    known = column.is_valid().to_numpy(zero_copy_only=False)
    raw, offsets = bytes_of(column.fill_null(b""))
    language = np.full(len(column), UNKNOWN, object)
    sure = np.zeros(len(column))
    cuts = np.flatnonzero(np.diff(offsets[1:] // TOGETHER, prepend=0))
    for a, b in zip([0, *cuts], [*cuts, len(column)], strict=True):
        if b > a and model is not None:
            part = raw[offsets[a] : offsets[b]]
            language[a:b], sure[a:b] = model.predict(part, offsets[a : b + 1] - offsets[a])
    language[~known], sure[~known] = UNKNOWN, 0.0
    return pa.array(language.tolist(), pa.string()), pa.array(np.clip(sure, 0, 1))


def accepted(docs: DataFrame, model: Model | None, **columns) -> DataFrame:
    """The rows with a letter in their text, with the columns of ``docs``.

    The language of every one of them is identified from its whole text.  It becomes ``lang`` where that
    is missing, ``und`` where there was nothing to learn from, and where it is another language than a
    ``lang`` that the machines have learnt, with a score above ``SURE``.  Labels of languages that they
    have not learnt stay.  No language is rejected, however low its score.
    """
    text_col, lang_col = columns.get("text_col", "text"), columns.get("lang_col", "lang")
    learnt = pa.array(model.languages if model else [], pa.string())

    def decide(batches):
        for raw, lang in batches:
            found, score = predicted(model, raw)
            lang = lang.cast(pa.string())
            wrong = pc.and_(pc.is_in(lang, value_set=learnt), pc.greater(score, SURE))
            yield pc.if_else(pc.or_(pc.is_null(lang), wrong), found, lang)

    # Only the text and its label go to Python.
    @F.arrow_udf("string")
    def language(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from giving_back(decide)(batches)

    decided = language(F.col(text_col).cast("binary"), F.col(lang_col))
    return docs.where(has_letters(text_col)).withColumn(lang_col, decided)
