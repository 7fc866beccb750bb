"""Byte-level BPE by overlapping chunks.

Texts up to ``CHUNK`` code points are one chunk and never leave their task.  A longer text is cut in
chunks that overlap; the chunks are pre-tokenised in parallel, each from its own start, which may lie
inside a pre-token.  What follows a pre-token boundary depends on the text after it alone, so from
the first boundary that two neighbouring chunks share on, both agree: there they are stitched.  If
the overlap holds no shared boundary (one run of letters longer than it, say), pre-tokenising goes on
from the last sure boundary until one is met.  The stitched pieces are then encoded by the merge
ranks, some at a time, and their digests carried on; decoding concatenates the bytes of the ids.  One
text is in one task, as its bytes and the starts of its pieces.

Inside a task all texts of an Arrow batch are split at once: the split pattern (letters, digits,
other signs, each with one leading space; contractions; white space) only asks for the classes of
neighbouring characters, so it is array work.  Distinct pieces are encoded once a batch, all pieces
of similar length merging side by side.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelex.llm.common import bytes_of, giving_back

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 16
OVERLAP = 256
#: Code points that a task splits and encodes together.
TOGETHER = 1 << 19
#: A piece of more bytes than this is a content of its own: it is not compared with others.
LONG_PIECE = 1 << 12
NO_PAIR = np.int32(1 << 30)

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
# Unicode's White_Space code points, and the endings of the split pattern.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
         0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point, made once a process."""
    if not _classes:
        kinds = {"L": LETTER, "N": NUMBER}
        every = np.fromiter(
            (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8
        )
        every[WHITE] = SPACE
        _classes.append(every)
    return _classes[0]


def read_ranks(path: str) -> list[bytes]:
    """The token bytes by id, of a vocabulary file on the driver."""
    with open(path, "rb") as lines:
        ranks = dict(line.split() for line in lines if line.strip())
    tokens: list[bytes] = [b""] * (1 + max(map(int, ranks.values())))
    for token, rank in ranks.items():
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where pieces begin in the code points of texts laid end to end; ``text_starts`` included.

    ``text_starts`` are the starts of the non-empty texts.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    fresh = np.zeros(n, bool)
    fresh[text_starts] = True
    change = fresh.copy()
    change[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(change)
    run_kind = kind[run]
    run_end = np.append(run[1:], n)
    starts = fresh.copy()
    # White space before something in the same text: its last character is a piece of its own or,
    # if it is a blank, the beginning of the next piece; what comes before it is one piece.
    inner = np.flatnonzero((run_kind == SPACE) & (run_end < n))
    inner = inner[~fresh[np.minimum(run_end[inner], n - 1)]]
    final = run_end[inner] - 1
    starts[run[run_kind == SPACE]] = True
    starts[final] = True
    blank = points[final] == 0x20
    starts[run_end[inner[~blank]]] = True
    # Other runs start a piece unless a blank leads them.
    led = np.zeros(n + 1, bool)
    led[run_end[inner[blank]]] = True
    solid = run[run_kind != SPACE]
    starts[solid[~led[solid]]] = True
    # Contractions: a run of other signs that begins with an apostrophe and has no leading blank.
    quote = run[(run_kind == OTHER) & (points[run] == 0x27)]
    quote = quote[~led[quote]]
    alone = change[np.minimum(quote + 1, n - 1)] & (quote + 1 < n)
    quote = quote[alone]
    if len(quote):
        bounds = np.append(np.asarray(text_starts), n)
        stop = bounds[np.searchsorted(bounds, quote, side="right")]
        done = np.zeros(len(quote), bool)
        for ending in ENDINGS:
            fits = ~done & (quote + len(ending) < stop)
            for k, letter in enumerate(ending):
                fits &= points[np.minimum(quote + 1 + k, n - 1)] == ord(letter)
            at = quote[fits]
            starts[at + 1] = False
            after = at + 1 + len(ending)
            after = after[after < n]
            starts[after] = True
            done |= fits
    return np.flatnonzero(starts)


class Vocabulary:
    """Ranks as arrays: ids of single bytes and a hash table from pairs of ids to the joined id."""

    def __init__(self, tokens: list[bytes]):
        ranks = {token: rank for rank, token in enumerate(tokens) if token}
        self.tokens = tokens
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, joined = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    joined.append(rank)
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        self.keys = np.full(1 << int(64 - self.shift), -1, np.int64)
        self.joined = np.full(len(self.keys), NO_PAIR, np.int32)
        self._fill(np.array(keys, np.int64), np.array(joined, np.int32))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def _fill(self, keys: np.ndarray, joined: np.ndarray) -> None:
        at, mask = self.slot(keys), len(self.keys) - 1
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]
            won = self.keys[at] == keys
            self.joined[at[won]] = joined[won]
            keys, joined, at = keys[~won], joined[~won], (at[~won] + 1) & mask

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined id of each pair, NO_PAIR where none exists."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        out = np.full(len(keys), NO_PAIR, np.int32)
        rest, mask = np.flatnonzero((left >= 0) & (right >= 0)), len(self.keys) - 1
        at = self.slot(keys[rest])
        while len(rest):
            found = self.keys[at]
            hit = found == keys[rest]
            out[rest[hit]] = self.joined[at[hit]]
            go = ~hit & (found != -1)
            rest, at = rest[go], (at[go] + 1) & mask
        return out

    def encode(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """The ids of many pieces of ``data`` laid end to end, and how many each has."""
        counts = np.zeros(len(starts), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for high in (4, 8, 12, 16, 24, 32, 64):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(rows):
                ids, n = self._side_by_side(data, starts[rows], sizes[rows], high)
                counts[rows] = n
                found.append((rows, ids))
        offsets = None
        for row in np.flatnonzero(sizes > 64):
            piece = data[starts[row] : starts[row] + sizes[row]]
            ids = self._long(piece)
            counts[row] = len(ids)
            found.append((np.array([row]), np.array(ids, np.int32)[None, :]))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(offsets[-1], np.int32)
        for rows, ids in found:
            column = np.arange(ids.shape[1])
            inside = column < counts[rows][:, None]
            flat[(offsets[rows][:, None] + column)[inside]] = ids[inside]
        return flat, counts

    def _side_by_side(self, data, starts, sizes, width):
        """One merge of every piece a round: its lowest pair, the leftmost of equals."""
        column = np.arange(width)
        inside = column < sizes[:, None]
        ids = np.full((len(starts), width), -1, np.int32)
        ids[inside] = self.single[data[(starts[:, None] + column)[inside]]]
        counts = sizes.copy()
        if width == 1:
            return ids, counts
        rank = self.pair(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), width - 1)
        rows = np.arange(len(ids))
        own, rank = ids.copy(), rank
        while True:
            at = rank.argmin(1)
            low = rank[np.arange(len(rank)), at]
            go = low < NO_PAIR
            if not go.all():
                ids[rows[~go]] = own[~go]
                rows, own, rank, at, low = rows[go], own[go], rank[go], at[go], low[go]
            if not len(rows):
                return ids, counts
            line = np.arange(len(rows))
            later = column[None, :] > at[:, None]
            pick = np.minimum(column[None, :] + later, width - 1)
            own = np.take_along_axis(own, pick, 1)
            own[:, -1] = -1
            own[line, at] = low
            rank = np.take_along_axis(rank, np.minimum(pick[:, :-1], width - 2), 1)
            rank[:, -1] = NO_PAIR
            after = np.minimum(at + 1, width - 1)
            fresh = self.pair(own[line, at], np.where(at + 1 < width, own[line, after], -1))
            inner = at < width - 1
            rank[line[inner], at[inner]] = fresh[inner]
            led = np.flatnonzero(at > 0)
            rank[led, at[led] - 1] = self.pair(own[led, at[led] - 1], own[led, at[led]])
            counts[rows] -= 1

    def _long(self, piece: np.ndarray) -> list[int]:
        """A long piece with a heap and linked neighbours: n log n steps."""
        import heapq

        n = len(piece)
        ids = self.single[piece].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        one = lambda a, b: int(self.pair(np.array([a]), np.array([b]))[0])
        first = self.pair(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < NO_PAIR]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    pair = (ids[a], ids[b])
                    if pair not in known:
                        known[pair] = one(*pair)
                    if known[pair] < NO_PAIR:
                        heapq.heappush(heap, (known[pair], a, *pair))
        return [i for i in ids if i >= 0]


def distinct_pieces(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Of each piece the number of its content, and where each content occurs first.

    Contents are told apart by a 64-bit hash of bytes and length, and then compared byte by byte.
    """
    long = sizes > LONG_PIECE
    if long.any():
        rest = np.flatnonzero(~long)
        number = np.empty(len(starts), np.int64)
        first = np.flatnonzero(long)
        number[first] = np.arange(len(first))
        if len(rest):
            own = np.cumsum(sizes[rest]) - sizes[rest]
            inside = np.repeat(~long, sizes)
            theirs, heads = distinct_pieces(data[inside], own, sizes[rest])
            number[rest] = theirs + len(first)
            first = np.append(first, rest[heads])
        return number, first
    weights = np.full(int(sizes.max()), 0x100000001B3, np.uint64)
    weights[0] = 1
    weights = np.cumprod(weights)
    place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
    mixed = weights[place]
    mixed *= data.astype(np.uint64) + np.uint64(0x9E37)
    code = np.add.reduceat(mixed, starts) * np.uint64(0x9E3779B97F4A7C15)
    del mixed
    code ^= (code >> np.uint64(29)) + sizes.astype(np.uint64)
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    same = sizes == sizes[first][number]
    if same.all():
        same = data == data[np.repeat(starts[first][number], sizes) + place]
    if not same.all():
        seen: dict[bytes, int] = {}
        whole = data.tobytes()
        pieces = [whole[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
        number = np.array([seen.setdefault(p, len(seen)) for p in pieces])
        first = np.unique(number, return_index=True)[1]
    return number, first


def encode_pieces(vocabulary: Vocabulary, data, starts, sizes):
    """Ids of all pieces in order, and the number of ids of each."""
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    number, first = distinct_pieces(data, starts, sizes)
    flat, counts = vocabulary.encode(data, starts[first], sizes[first])
    offsets = np.cumsum(counts) - counts
    own = counts[number]
    ends = np.cumsum(own)
    return flat[np.arange(ends[-1]) + np.repeat(offsets[number] - (ends - own), own)], own


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def utf8_places(points: np.ndarray) -> np.ndarray:
    """The byte offset of every code point, and of the end."""
    sizes = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(sizes)])


def encode_texts(vocabulary: Vocabulary, texts: list[str]) -> list[np.ndarray]:
    """The ids of every text."""
    joined = "".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    points = code_points(joined)
    starts = piece_starts(points, (ends - lengths)[lengths > 0])
    places = utf8_places(points)
    data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    at = places[starts]
    ids, own = encode_pieces(vocabulary, data, at, np.diff(np.append(at, len(data))))
    upto = np.concatenate([[0], np.cumsum(own)])[np.searchsorted(starts, ends)]
    return np.split(ids, upto[:-1])[: len(texts)]


def sure_starts(starts: np.ndarray, length: int, last: bool) -> np.ndarray:
    """Without those that text beyond the chunk could move."""
    return starts if last else starts[starts < length - 4][:-1]


def stitch(text: str, starts: list[int], own: list[np.ndarray]) -> np.ndarray:
    """Piece starts of the whole text from those of its chunks, all counted from the text's start."""
    whole = own[0]
    for start, mine in zip(starts[1:], own[1:], strict=True):
        shared = np.intersect1d(whole[whole >= start], mine)
        reach = 4 * OVERLAP
        while not len(shared):
            at = int(whole[-1]) if len(whole) else 0
            part = code_points(text[at : start + reach])
            more = piece_starts(part, np.array([0])) + at
            if start + reach < len(text):
                more = sure_starts(more, start + reach, False)
            shared = np.intersect1d(more[more >= start], mine)
            if len(shared) or start + reach >= len(text):
                whole = np.union1d(whole, more)
                break
            reach *= 2
        if len(shared):
            whole = np.concatenate([whole[whole < shared[0]], mine[mine >= shared[0]]])
    return whole


class Digest:
    """Token count and digests of one text, from its ids in order."""

    def __init__(self, vocabulary: Vocabulary, numbers: list[str]):
        self.vocabulary, self.numbers = vocabulary, numbers
        self.count, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray) -> None:
        listed = ids.tolist()
        if listed:
            text = " ".join(map(self.numbers.__getitem__, listed))
            self.ids.update((" " + text if self.count else text).encode())
            self.decoded.update(b"".join(map(self.vocabulary.tokens.__getitem__, listed)))
            self.count += len(listed)

    def result(self) -> tuple[int, str, str]:
        return self.count, self.ids.hexdigest(), self.decoded.hexdigest()


def _digests(vocabulary: Vocabulary, numbers: list[str], ids: np.ndarray) -> tuple:
    own = Digest(vocabulary, numbers)
    own.add(ids)
    return own.result()


def encode_parts(vocabulary: Vocabulary, text: str, starts: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of a text from its piece starts, about ``TOGETHER`` code points at a time."""
    bounds = np.append(starts, len(text))
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + TOGETHER, side="right")) - 1)
        part = text[bounds[at] : bounds[end]]
        places = utf8_places(code_points(part))
        data = np.frombuffer(part.encode("utf-8", "surrogatepass"), np.uint8)
        begin = places[bounds[at:end] - bounds[at]]
        yield encode_pieces(vocabulary, data, begin, np.diff(np.append(begin, len(data))))[0]
        at = end


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
DIGEST_NAMES = ["n_tokens", "ids_sha256", "decoded_sha256"]


def encode(
    docs: DataFrame,
    ranks_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    with_ids: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256; ``ids`` too if asked for.

    Null is the empty text, which has no ids.  Every row gives one row, repeated and null ids too;
    ``carry`` names columns returned in the struct ``row``.
    """
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    )
    kept = [f for f in base.schema.fields if f.name != "text"]
    names = [f.name for f in kept]
    kept_ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    out = f"{kept_ddl}, {DIGESTS}" + (", ids array<int>" if with_ids else "")
    out_names = [*names, *DIGEST_NAMES] + (["ids"] if with_ids else [])

    def results(vocabulary, numbers, arrays, lists) -> pa.RecordBatch:
        return table_of(arrays, [_digests(vocabulary, numbers, ids) for ids in lists], lists)

    def table_of(arrays, digests, lists) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.string())
        columns = zip(*digests, strict=True)
        arrays = [*arrays, *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))]
        if with_ids:
            arrays.append(pa.array([ids.tolist() for ids in lists], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names=out_names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, numbers = Vocabulary(tokens.value), list(map(str, range(len(tokens.value))))
        for batch in batches:
            sizes = np.diff(bytes_of(batch.column("text"))[1])
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // TOGETHER, prepend=0))
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if b > a:
                    part = batch.slice(a, b - a)
                    texts = part.column("text").to_pylist()
                    arrays = [part.column(n) for n in names]
                    yield results(vocabulary, numbers, arrays, encode_texts(vocabulary, texts))
                    del part, texts, arrays
            del batch

    short = base.where(F.length("text") <= chunk).mapInArrow(giving_back(whole), out)
    long = base.where(F.length("text") > chunk).withColumn("uid", F.monotonically_increasing_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunk rows; the other columns travel on a text's first chunk."""
        for batch in batches:
            rows = zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for row, (uid, text) in enumerate(rows):
                starts = list(range(0, len(text), chunk))
                first = pa.array([row] + [None] * (len(starts) - 1), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(n).take(first) for n in names),
                        pa.array([uid] * len(starts), pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array([s + chunk + overlap >= len(text) for s in starts], pa.bool_()),
                        pa.array([text[s : s + chunk + overlap] for s in starts], pa.string()),
                    ],
                    names=[*names, "uid", "start", "last", "part"],
                )

    def split_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part, last in zip(
                batch.column("part").to_pylist(), batch.column("last").to_pylist(), strict=True
            ):
                own = piece_starts(code_points(part), np.array([0]))
                found.append(sure_starts(own, len(part), last).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())],
                names=[*batch.schema.names, "starts"],
            )

    def join_chunks(chunks: pa.Table) -> pa.Table:
        vocabulary, numbers = Vocabulary(tokens.value), list(map(str, range(len(tokens.value))))
        chunks = chunks.sort_by("start")
        first, parts = chunks["start"].to_pylist(), chunks["part"].to_pylist()
        text = "".join([p[:chunk] for p in parts])
        own = [
            np.frombuffer(s, np.int32).astype(np.int64) + a
            for s, a in zip(chunks["starts"].to_pylist(), first, strict=True)
        ]
        starts = stitch(text, first, own)
        arrays = [chunks[n].slice(0, 1).combine_chunks() for n in names]
        del chunks, parts, own
        digest, ids = Digest(vocabulary, numbers), []
        for part in encode_parts(vocabulary, text, starts):
            digest.add(part)
            if with_ids:
                ids.append(part)
        return pa.Table.from_batches([table_of(arrays, [digest.result()], ids and [np.concatenate(ids)])])

    chunk_ddl = f"{kept_ddl}, uid long, start long, last boolean, part string"
    chunks = long.mapInArrow(giving_back(cut), chunk_ddl).repartition(F.col("uid"), F.col("start"))
    stitched = (
        chunks.mapInArrow(giving_back(split_chunks), f"{chunk_ddl}, starts binary")
        .groupBy("uid")
        .applyInArrow(join_chunks, out)
    )
    return short.unionByName(stitched)
