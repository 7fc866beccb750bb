"""Similarity self-join of documents on word shingles: a grouped prefix join, and its components.

1. *Order.*  One pass counts words and shingles and keeps the frequent ones, whose number is bounded:
   words that make up at least ``WORD_SHARE`` of all, shingles in at least ``SHINGLE_SHARE`` of the
   documents.  Shingles of rare words come first in the common order, frequent shingles last.
2. *Sets.*  A document becomes a set of hashed shingles; equal sets are one class.  The prefix of a
   set of n is its first n - ceil(n * t) + 1 shingles: two linked sets share one of them.
3. *Groups.*  Classes of equal prefix and size are one group, with the most frequent class as its
   representative.  Only representatives are indexed.
4. *Group pairs.*  A shingle's entries are sorted, heaviest group first, and read as a stream; every
   entry is paired with the first one if size and position let them link.  Members are paired with
   their group's representative.  These stars are verified on the complete texts and joined to
   components.
5. *The rest.*  Any other pair of groups with a common prefix shingle, and any two members of a
   group, are expanded to members and verified unless they are in one component already.  So no link
   between different components is missed, and a large group of near copies costs one star.

Before texts are fetched, a pair must pass its parity sketches: every shingle of a set flips one of
``SKETCH`` bits, so two sets differ in at least as many shingles as their sketches differ in bits.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelex.llm.common import bytes_of, giving_back, saved
from lodgelex.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 3
PERCENT = 90
WORD_SHARE = 1e-5
SHINGLE_SHARE = 2e-3
#: Bytes that a task tokenises together, and over which it counts before reporting.
TOGETHER = 1 << 20
WINDOW = 8 << 20
LEAST_REPEATS = 8

#: Bits of a set's parity sketch.
SKETCH = 1024
#: Sets above this size have a wide sketch besides, with at least as many bits as shingles up to the
#: largest width.
WIDE_FROM, WIDEST = 2048, 1 << 16
#: Numbers that ids are hashed to before texts are fetched.
COARSE = 1 << 20

_U = np.uint64


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    white = np.zeros(256, bool)
    white[[0x20, *range(0x09, 0x0E)]] = True
    return lower, white


LOWER, WHITE = _tables()
FACTOR = _U(0x9E3779B97F4A7C15)
MIXERS = [_U(m) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                          0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out)


def word_codes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all words in order, and where each text's words begin (and the end)."""
    n = len(raw)
    if not n:
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    solid = ~WHITE[raw]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    begin[edges] |= solid[edges]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    spans = np.diff(np.append(starts, n))
    first = starts[0]
    place = np.arange(first, n) - np.repeat(starts, spans)
    low, high = _powers(MIXERS[0], 1 << 12), None
    if int(spans.max()) > 1 << 12:
        high = _powers(mixed(MIXERS[0:1] + np.zeros(1, _U))[0] | _U(1), 1 + (int(spans.max()) >> 12))
    weight = low[place & 0xFFF] if high is None else low[place & 0xFFF] * high[place >> 12]
    value = (LOWER[raw[first:]].astype(_U) + _U(0x51)) * weight
    value[~solid[first:]] = 0
    codes = mixed(np.add.reduceat(value, starts - first) * FACTOR)
    return codes, np.searchsorted(starts, offsets)


def shingle_codes(words: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every text's shingles in order (repeats included) and where each text's begin.

    A text of fewer than ``width`` words has its whole sequence as one shingle, one without words none.
    """
    counts = np.diff(at)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(begin[-1], _U)
    full = np.repeat(counts >= width, sizes)
    source = np.arange(begin[-1]) + np.repeat(at[:-1] - begin[:-1], sizes)
    rows = source[full]
    total = np.zeros(len(rows), _U)
    factors = _powers(MIXERS[1], width + 1)[1:]
    for k in range(width):
        total += words[rows + k] * factors[k]
    out[full] = mixed(total)
    for text in np.flatnonzero((counts > 0) & (counts < width)):
        own = words[at[text] : at[text + 1]]
        code = np.array([(own * factors[: len(own)]).sum(dtype=_U), len(own)], _U) * MIXERS[2]
        out[begin[text]] = mixed(mixed(code[:1]) + code[1:])[0]
    return out, begin


def slices(column: pa.Array, together: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about so many bytes, with their bytes and offsets."""
    raw, offsets = bytes_of(column.fill_null(b""))
    cuts = np.flatnonzero(np.diff(offsets[1:] // together, prepend=0))
    for a, b in zip([0, *cuts], [*cuts, len(column)], strict=True):
        if b > a:
            yield a, b, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


class Order:
    """Places shingles in the common order: rare ones first."""

    def __init__(self, words: list[tuple[int, int]], shingles: list[tuple[int, int]],
                 n_words: int, n_docs: int, word_share: float, width: int):
        self.words, self.word_score = self._table(words, max(1, n_words))
        self.floor, self.width = float(np.log2(word_share / 2)), width
        self.shingles, self.shingle_score = self._table(shingles, max(1, n_docs))

    @staticmethod
    def _table(counts, total):
        counts = sorted((code & (1 << 64) - 1, n) for code, n in counts)
        codes = np.array([c for c, _ in counts], _U)
        return codes, np.log2(np.array([n for _, n in counts], float) / total + 1e-12)

    def word_scores(self, words: np.ndarray) -> np.ndarray:
        score = np.full(len(words), self.floor)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            hit = self.words[at] == words
            score[hit] = self.word_score[at[hit]]
        return score

    def keys(self, words, at, shingles, begin) -> np.ndarray:
        """Sort keys, not negative: 15 bits of frequency, then 48 bits of the code."""
        score = self.word_scores(words)
        counts = np.diff(at)
        sizes = np.diff(begin)
        source = np.arange(len(shingles)) + np.repeat(at[:-1] - begin[:-1], sizes)
        total = score[source]
        last = np.repeat(at[1:] - 1, sizes)
        for k in range(1, self.width):
            total = total + np.where(np.repeat(counts, sizes) > k, score[np.minimum(source + k, last)], 0.0)
        rank = np.clip((total - self.width * self.floor) * 500, 0, 29_999).astype(np.int64)
        if len(self.shingles):
            pos = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
            hit = self.shingles[pos] == shingles
            rank[hit] = (32_000 + np.clip(self.shingle_score[pos[hit]], -20, 0) * 100).astype(np.int64)
        return rank.astype(_U) << _U(48) | shingles >> _U(16)


def count_frequent(
    docs: DataFrame, text_col: str, width: int, word_share: float, shingle_share: float
) -> Order:
    """The order of shingles, from counts over all documents.

    A window of a task reports what is frequent in it, so that at most 1 / share codes leave it; a
    code that is frequent over all is frequent in some window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shingles, held, texts = [], [], 0, 0
        for batch in batches:
            for a, b, raw, offsets in slices(batch.column(0), TOGETHER):
                codes, at = word_codes(raw, offsets)
                found, begin = shingle_codes(codes, at, width)
                words.append(codes)
                shingles += [np.unique(found[x:y]) for x, y in zip(begin[:-1], begin[1:], strict=True)]
                held += len(raw)
                texts += b - a
                if held >= WINDOW:
                    yield report(words, shingles, texts)
                    words, shingles, held, texts = [], [], 0, 0
        if texts:
            yield report(words, shingles, texts)

    def report(words, shingles, texts) -> pa.RecordBatch:
        kinds, codes, counts = [0, 1], [0, 0], [sum(map(len, words)), texts]
        for kind, parts, least in (
            (2, words, word_share * counts[0]), (3, shingles, shingle_share * texts)
        ):
            if parts:
                code, n = np.unique(np.concatenate(parts), return_counts=True)
                often = n >= max(LEAST_REPEATS, least)
                kinds += [kind] * int(often.sum())
                codes += code[often].view(np.int64).tolist()
                counts += n[often].tolist()
        return pa.RecordBatch.from_pydict(
            {"kind": pa.array(kinds, pa.int32()), "code": pa.array(codes, pa.int64()),
             "n": pa.array(counts, pa.int64())}
        )

    reported = docs.select(F.col(text_col).cast("binary").alias("raw")).mapInArrow(
        giving_back(run), "kind int, code long, n long"
    )
    counted = saved(reported.groupBy("kind", "code").agg(F.sum("n").alias("n")), "frequent")
    totals = {r["kind"]: r["n"] for r in counted.where("kind < 2").collect()}
    n_words, n_docs = totals.get(0, 0), totals.get(1, 0)
    # At most 1 / word_share words and (shingles per document) / shingle_share shingles remain.
    kept = counted.where(
        ((F.col("kind") == 2) & (F.col("n") >= word_share * n_words))
        | ((F.col("kind") == 3) & (F.col("n") >= shingle_share * n_docs))
    ).collect()
    return Order(
        [(r["code"], r["n"]) for r in kept if r["kind"] == 2],
        [(r["code"], r["n"]) for r in kept if r["kind"] == 3],
        n_words, n_docs, word_share, width,
    )


def least_overlap(n: int, percent: int) -> int:
    """What a set of n must share with any partner."""
    return -(-percent * n // 100)


def set_key(codes: np.ndarray) -> bytes:
    return hashlib.blake2b(codes.tobytes(), digest_size=16).digest()


def parity_sketch(codes: np.ndarray) -> np.ndarray:
    """The parity of the number of codes at each bit, as 64-bit integers."""
    odd = np.bincount((codes & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(codes: np.ndarray) -> bytes | None:
    """The parity at each bit of a number of bits that fits the size of a large set."""
    if len(codes) <= WIDE_FROM:
        return None
    width = min(WIDEST, 1 << (len(codes) - 1).bit_length())
    odd = np.bincount((codes & _U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing_bits(x: bytes, y: bytes) -> int:
    """In how many bits two wide sketches differ; the wider one is folded to the other's width."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    folded = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ folded).sum())


def sketches_allow(n1, n2, sketch1, sketch2, percent: int):
    """Whether the sketches differ in no more bits than linked sets differ in shingles."""
    bits = sum(
        F.bit_count(F.get(sketch1, F.lit(i)).bitwiseXOR(F.get(sketch2, F.lit(i))))
        for i in range(SKETCH // 64)
    )
    return (100 + percent) * bits <= (100 - percent) * (n1 + n2)


def prefixes(docs: DataFrame, order: Order, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Per row: uid, doc_id, text_key, n, set_key, prefix_key, prefix and sketches (null for the empty
    set; the wide sketch for large sets only)."""
    width = order.width
    shipped = docs.sparkSession.sparkContext.broadcast(
        (order.words, order.word_score, order.shingles, order.shingle_score, order.floor)
    )
    base = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("binary").alias("raw"),
    ).withColumn("text_key", F.xxhash64("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Order([], [], 1, 1, 1.0, width)
        own.words, own.word_score, own.shingles, own.shingle_score, own.floor = shipped.value
        for batch in batches:
            for a, b, raw, offsets in slices(batch.column("raw"), TOGETHER):
                words, at = word_codes(raw, offsets)
                codes, begin = shingle_codes(words, at, width)
                keys = own.keys(words, at, codes, begin)
                sizes, sets, groups, heads, sketches, wide = [], [], [], [], [], []
                for x, y in zip(begin[:-1], begin[1:], strict=True):
                    if x == y:
                        sizes.append(0)
                        for column in (sets, groups, heads, sketches, wide):
                            column.append(None)
                        continue
                    distinct, where = np.unique(codes[x:y], return_index=True)
                    n = len(distinct)
                    length = n - least_overlap(n, percent) + 1
                    chosen = keys[x:y][where]
                    if length < n:
                        chosen = np.partition(chosen, length - 1)[:length]
                    head = np.sort(chosen).view(np.int64)
                    sizes.append(n)
                    sets.append(set_key(distinct))
                    groups.append(
                        hashlib.blake2b(head.tobytes() + n.to_bytes(8, "little"), digest_size=16).digest()
                    )
                    heads.append(head)
                    sketches.append(parity_sketch(distinct))
                    wide.append(wide_sketch(distinct))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("doc_id"), part.column("text_key"),
                     pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(groups, pa.binary()),
                     pa.array(heads, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
                     pa.array(wide, pa.binary())],
                    names=["uid", "doc_id", "text_key", "n", "set_key", "prefix_key", "prefix", "sketch", "wide"],
                )

    return base.mapInArrow(
        giving_back(run),
        "uid long, doc_id long, text_key long, n long, set_key binary, prefix_key binary, "
        "prefix array<long>, sketch array<long>, wide binary",
    )


def may_link(n1, n2, pos1, pos2, percent: int):
    """Size and position filters; works on arrays and on columns alike."""
    both = (100 * n1 >= percent * n2) & (100 * n2 >= percent * n1)
    need = percent * (n1 + n2)
    return both & ((100 + percent) * (n1 - pos1) >= need) & ((100 + percent) * (n2 - pos2) >= need)


def stars(index: DataFrame, percent: int) -> DataFrame:
    """Pairs of each shingle's first entry with the others, and the entries of runs of 3 or more.

    The first entry is the heaviest group, of equal ones the smallest: near copies meet the same one
    at every shingle they share, so their pairs grow with their number.

    A pair row has ``b``; an entry row has ``token, n, pos`` instead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]])
            if carried is not None and len(carried[0]) and carried[0, -1] == columns[0, 0]:
                columns = np.concatenate([carried, columns], axis=1)
            token, gid, n, pos = columns
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            spans = np.diff(np.append(starts, len(token)))
            # A run that goes on in the next batch takes its first entries along; repeats are harmless.
            carried = columns[:, starts[-1] : starts[-1] + 3]
            if spans.max() < 2:
                continue
            lead = np.repeat(starts, spans)
            keep = (lead != np.arange(len(token))) & may_link(n[lead], n, pos[lead], pos, percent)
            keep &= gid[lead] != gid
            rest = np.repeat(spans >= 3, spans)
            k, r = int(keep.sum()), int(rest.sum())
            none = lambda m: pa.nulls(m, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(gid[lead][keep]), pa.array(gid[rest])]),
                    pa.concat_arrays([pa.array(gid[keep]), none(r)]),
                    pa.concat_arrays([none(k), pa.array(token[rest])]),
                    pa.concat_arrays([none(k), pa.array(n[rest])]),
                    pa.concat_arrays([none(k), pa.array(pos[rest])]),
                ],
                names=["a", "b", "token", "n", "pos"],
            )

    return (
        index.select("token", "gid", "n", "pos", "weight")
        .repartition(F.col("token"))
        .sortWithinPartitions("token", F.desc("weight"), "gid", "pos")
        .mapInArrow(giving_back(run), "a long, b long, token long, n long, pos long")
    )


def verify(docs: DataFrame, pairs: DataFrame, classes: DataFrame, id_col: str, text_col: str,
           width: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) of classes those that link, decided on the complete shingle sets."""
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid")))
    held = classes.select("sid", "first_id", "text_key", "set_key")
    handles = saved(wanted.distinct().join(held, "sid"), "handles")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("raw")
    )
    # Texts that surely are not wanted stay where they are: at most COARSE numbers are broadcast.
    with_id = rows.where("id is not null").join(
        F.broadcast(_numbers(handles, "first_id")), _coarse("id") == F.col("number"), "left_semi"
    ).join(handles, F.col("id") == F.col("first_id")).select("sid", "set_key", "raw")
    # A class without any id is found by the hash of one of its texts, and copies of it count once.
    nameless = handles.where("first_id is null")
    without = (
        rows.where("id is null").withColumn("hash", F.xxhash64("raw"))
        .join(nameless, F.col("hash") == F.col("text_key"))
        .select("sid", "set_key", "raw").distinct()
    )
    found = with_id.unionByName(without)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids may repeat: only the text whose set is the class's goes on."""
        for batch in batches:
            right = np.zeros(batch.num_rows, bool)
            keys = batch.column("set_key").to_pylist()
            for a, _, raw, offsets in slices(batch.column("raw"), TOGETHER):
                codes, begin = shingle_codes(*word_codes(raw, offsets), width)
                for k, (x, y) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
                    right[a + k] = set_key(np.unique(codes[x:y])) == keys[a + k]
            out = batch.filter(pa.array(right))
            yield pa.RecordBatch.from_arrays([out.column("sid"), out.column("raw")], names=["sid", "raw"])

    texts = saved(found.mapInArrow(giving_back(check), "sid long, raw binary"), "candidates")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            lefts = {}
            seen: dict[int, int] = {}
            for row, a in enumerate(first):
                seen.setdefault(a, row)
            rows = pa.array(list(seen.values()), pa.int64())
            names = list(seen)
            for a, _, raw, offsets in slices(batch.column("raw_a").take(rows), TOGETHER):
                codes, begin = shingle_codes(*word_codes(raw, offsets), width)
                for k, (x, y) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
                    lefts[names[a + k]] = np.unique(codes[x:y])
            linked = []
            for a, _, raw, offsets in slices(batch.column("raw_b"), TOGETHER):
                codes, begin = shingle_codes(*word_codes(raw, offsets), width)
                for k, (x, y) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
                    left, right = lefts[first[a + k]], np.unique(codes[x:y])
                    merged = np.concatenate([left, right])
                    merged.sort(kind="stable")
                    shared = int((merged[1:] == merged[:-1]).sum())
                    if 100 * shared >= percent * (len(left) + len(right) - shared):
                        linked.append((first[a + k], second[a + k]))
            if linked:
                x, y = zip(*linked, strict=True)
                yield pa.RecordBatch.from_pydict({"a": list(x), "b": list(y)})

    right = texts.select(F.col("sid").alias("b"), F.col("raw").alias("raw_b"))
    left = texts.select(F.col("sid").alias("a"), F.col("raw").alias("raw_a"))
    together = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "raw_a", "raw_b")
    return together.mapInArrow(giving_back(compare), "a long, b long")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(
        "a != b"
    ).distinct()


def _coarse(key: str):
    return F.pmod(F.xxhash64(key), F.lit(COARSE))


def _numbers(keys: DataFrame, key: str) -> DataFrame:
    """What the keys are hashed to: at most ``COARSE`` rows, so they can be broadcast at any size."""
    return keys.select(_coarse(key).alias("number")).distinct()


def plausible(pairs: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches allow.  ``sketched``: sid, n, sketch, wide."""
    x, y = (
        sketched.select(F.col("sid").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}"))
        for k in "ab"
    )
    x = x.join(F.broadcast(_numbers(pairs, "a")), _coarse("a") == F.col("number"), "left_semi")
    y = y.join(F.broadcast(_numbers(pairs, "b")), _coarse("b") == F.col("number"), "left_semi")
    both = pairs.join(x, "a").join(y, "b")
    both = both.where(
        (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))
        & sketches_allow(F.col("na"), F.col("nb"), "sa", "sb", percent)
    ).select("a", "b", "na", "nb")
    both = saved(both, "sketched-pairs")
    large = (F.col("na") > WIDE_FROM) & (F.col("nb") > WIDE_FROM)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            bits = np.fromiter(
                map(differing_bits, batch.column("wa").to_pylist(), batch.column("wb").to_pylist()),
                np.int64, batch.num_rows,
            )
            out = batch.filter(pa.array((100 + percent) * bits <= (100 - percent) * n))
            yield pa.RecordBatch.from_arrays([out.column("a"), out.column("b")], names=["a", "b"])

    wide = sketched.where("wide is not null")
    wa, wb = (
        wide.join(F.broadcast(_numbers(both.where(large), k)), _coarse("sid") == F.col("number"), "left_semi")
        .select(F.col("sid").alias(k), F.col("wide").alias(f"w{k}"))
        for k in "ab"
    )
    compared = both.where(large).join(wa, "a").join(wb, "b").select("a", "b", "na", "nb", "wa", "wb")
    return both.where(~large).select("a", "b").unionByName(
        compared.mapInArrow(giving_back(check), "a long, b long")
    )


def rest_of_pairs(entries, group_pairs, members, sketched, percent: int) -> DataFrame:
    """Pairs of members in different components that the stars have not compared.

    ``entries``: token, gid, n, pos of runs of 3 or more; ``group_pairs``: those already paired by
    their representatives; ``members``: sid, gid, comp; ``sketched``: sid, n, sketch.
    """
    units = members.groupBy("gid", "comp").agg(F.count("*").alias("size"))
    # Other pairs of groups: one side outside the component that most entries of the shingle have.
    placed = entries.join(units, "gid").select("token", "gid", "n", "pos", "comp")
    tally = placed.groupBy("token", "comp").agg(F.count("*").alias("rows"))
    mixed_tokens = (
        tally.groupBy("token")
        .agg(F.max(F.struct("rows", "comp"))["comp"].alias("main"), F.count("*").alias("comps"))
        .where("comps > 1")
        .select("token", "main")
    )
    # A group of one class is judged by its sketch here, a larger one after its members are known.
    alone = units.groupBy("gid").agg(F.sum("size").alias("classes")).where("classes = 1").select("gid")
    open_rows = saved(placed.join(mixed_tokens, "token"), "open-entries")
    known = (
        sketched.join(F.broadcast(_numbers(open_rows, "gid")), _coarse("sid") == F.col("number"), "left_semi")
        .join(alone, F.col("sid") == F.col("gid")).select("gid", "sketch")
    )
    open_entries = open_rows.join(known, "gid", "left")
    x = open_entries.where("comp != main").select(
        "token", F.col("gid").alias("g1"), F.col("comp").alias("c1"), F.col("n").alias("n1"),
        F.col("pos").alias("p1"), F.col("sketch").alias("k1"),
    )
    y = open_entries.select(
        "token", F.col("gid").alias("g2"), F.col("comp").alias("c2"), F.col("n").alias("n2"),
        F.col("pos").alias("p2"), F.col("sketch").alias("k2"),
    )
    filters = may_link(F.col("n1"), F.col("n2"), F.col("p1"), F.col("p2"), percent) & F.coalesce(
        sketches_allow(F.col("n1"), F.col("n2"), "k1", "k2", percent), F.lit(True)
    )
    by_token = x.join(y, (x["token"] == y["token"]) & (F.col("c1") != F.col("c2")) & filters).select(
        "g1", "c1", "g2", "c2"
    )
    u1 = units.select(F.col("gid").alias("g1"), F.col("comp").alias("c1"), F.col("size").alias("s1"))
    u2 = units.select(F.col("gid").alias("g2"), F.col("comp").alias("c2"), F.col("size").alias("s2"))
    by_pair = (
        group_pairs.select(F.col("a").alias("g1"), F.col("b").alias("g2"))
        .join(u1, "g1").join(u2, "g2")
        .where("c1 != c2 and (s1 > 1 or s2 > 1 or c1 != g1 or c2 != g2)")
        .select("g1", "c1", "g2", "c2")
    )
    inside = (
        u1.join(u2, (F.col("g1") == F.col("g2")) & (F.col("c1") < F.col("c2")))
        .select("g1", "c1", "g2", "c2")
    )
    every = by_token.unionByName(by_pair).unionByName(inside).distinct()
    m1 = members.select(F.col("gid").alias("g1"), F.col("comp").alias("c1"), F.col("sid").alias("a"))
    m2 = members.select(F.col("gid").alias("g2"), F.col("comp").alias("c2"), F.col("sid").alias("b"))
    pairs = every.join(m1, ["g1", "c1"]).join(m2, ["g2", "c2"]).select("a", "b")
    return plausible(saved(ordered(pairs), "rest-all"), sketched, percent)


def linked_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    word_share: float = WORD_SHARE,
    shingle_share: float = SHINGLE_SHARE,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable by links).

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``width``-word
    shingles; fewer words make one shingle.  Texts
    without words, and null, have the empty set and link with nothing: their component is their own
    id.  Rows without an id take part; a component of such rows alone has a null component_id.
    Repeated ids are separate rows.  An empty table gives an empty result.
    """
    order = count_frequent(docs, text_col, width, word_share, shingle_share)
    rows = saved(prefixes(docs, order, id_col, text_col, percent), "sets")
    classes = saved(
        rows.where("n > 0").groupBy("set_key").agg(
            F.min("uid").alias("sid"), F.count("*").alias("copies"), F.min("doc_id").alias("first_id"),
            F.min(F.when(F.col("doc_id").isNull(), F.col("text_key"))).alias("text_key"),
        ),
        "classes",
    )
    narrow = rows.select("uid", "prefix_key").join(
        classes.select("sid", "copies"), F.col("uid") == F.col("sid")
    ).drop("uid")
    sketched = rows.where("n > 0").select(F.col("uid").alias("sid"), "n", "sketch", "wide")
    groups = narrow.groupBy("prefix_key").agg(
        F.max(F.struct("copies", (-F.col("sid")).alias("s"))).alias("best"), F.count("*").alias("size")
    ).select("prefix_key", (-F.col("best.s")).alias("gid"), F.col("best.copies").alias("weight"), "size")
    grouped = narrow.join(groups, "prefix_key").select("sid", "gid", "size")
    grouped = saved(grouped, "groups")

    # Prefixes are long: they are kept from a shuffle wherever the planner can broadcast the few rows
    # that represent no group and the few groups of more than one copy.
    others = rows.where("n > 0").select("uid").join(
        groups.select("gid"), F.col("uid") == F.col("gid"), "left_anti"
    )
    heavy = groups.where("weight > 1").select("gid", "weight")
    index = (
        rows.where("n > 0").select(F.col("uid").alias("gid"), "n", "prefix")
        .join(others, F.col("gid") == F.col("uid"), "left_anti")
        .join(heavy, "gid", "left")
        .select("gid", "n", F.coalesce("weight", F.lit(1)).alias("weight"),
                F.posexplode("prefix").alias("pos", "token"))
        .withColumn("pos", F.col("pos").cast("long"))
    )
    found = saved(stars(index, percent), "stars")
    group_pairs = saved(ordered(found.where("b is not null").select("a", "b")), "group-pairs")
    in_groups = grouped.where("sid != gid").select(F.col("gid").alias("a"), F.col("sid").alias("b"))
    star_pairs = ordered(group_pairs.unionByName(in_groups))
    star_pairs = saved(star_pairs, "all-star-pairs")
    likely = saved(plausible(star_pairs, sketched, percent), "star-pairs")
    links = saved(verify(docs, likely, classes, id_col, text_col, width, percent), "star-links")
    first = components(links)

    members = grouped.join(first, F.col("sid") == F.col("node"), "left").select(
        "sid", "gid", F.coalesce("component", "sid").alias("comp")
    )
    members = saved(members, "members")
    entries = found.where("token is not null").select("token", F.col("a").alias("gid"), "n", "pos")
    rest = rest_of_pairs(entries, group_pairs, members, sketched, percent)
    rest = saved(rest.join(likely, ["a", "b"], "left_anti"), "rest-pairs")
    if rest.isEmpty():
        final = first
    else:
        more = saved(verify(docs, rest, classes, id_col, text_col, width, percent), "rest-links")
        star_edges = first.where("node != component").select(
            F.col("node").alias("a"), F.col("component").alias("b")
        )
        final = components(star_edges.unionByName(more)) if not more.isEmpty() else first

    placed = classes.join(final, F.col("sid") == F.col("node"), "left").select(
        "set_key", "first_id", F.coalesce("component", "sid").alias("comp")
    )
    smallest = placed.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    of_set = placed.join(smallest, "comp").select("set_key", "component_id")
    with_sets = rows.where("n > 0").select("doc_id", "n", "set_key").join(of_set, "set_key").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )
    without = rows.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return with_sets.unionByName(without)


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that stay, with the columns of ``docs``: of each component the smallest id.

    Rows of one id are one document and stay or go together; rows without an id stay.
    """
    found = linked_components(docs, id_col, text_col, **options)
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
