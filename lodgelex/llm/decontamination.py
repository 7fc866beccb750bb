"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised test items become one automaton: its states are the classes of word sequences that
end at the same places of the items, a state's link leads to its longest suffix of another class.
Training texts are streamed through it.  After each word the state and the length of the longest
word sequence that ends here and occurs in an item are known; where the length reaches ``window``,
the last ``window`` words stand in an item, and the state with exactly that suffix tells in which.
Items shorter than the window must occur whole.

The words of a slice of texts are numbered at once, and the stream is cut in lanes that go through
the automaton side by side.  A lane starts ``REACH`` words early, so its state holds every match of
up to that length when its own words begin.

The automata are built by tasks, one for about ``PART_WORDS`` words of items, and each is broadcast:
its size is bounded by that number.  With one part, texts are read once and nothing is shuffled.  With
several, each reads the texts once and gives out the texts it hit only; those meet by content.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelex.llm.common import bytes_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
#: Words of items in one automaton: at most twice as many states and three times as many steps.
PART_WORDS = 1 << 19
#: An item longer than this is cut, with ``window - 1`` words shared, so that every window is whole.
PIECE_WORDS = 1 << 15
#: Bytes of text that a task streams together, words of a lane, words that lanes share.
SLICE = 1 << 21
LANE = 512
REACH = 128

# The signs of a word are a to z, digits and everything beyond ASCII.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lowering() -> np.ndarray:
    """Bytes in lower case, 0 for those outside words."""
    table = np.zeros(256, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    for c in b"abcdefghijklmnopqrstuvwxyz":
        table[c] = table[c - 32] = c
    for c in b"0123456789":
        table[c] = c
    return table


LOWERING = _lowering()


class Slots:
    """A hash table from whole numbers to small ones, both as arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * max(1, len(keys))).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        at, mask = self._slot(keys), len(self.keys) - 1
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + 1) & mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it has none."""
        out = np.full(len(keys), -1, np.int32)
        rest, at, mask = np.arange(len(keys)), self._slot(keys), len(self.keys) - 1
        while len(rest):
            held = self.keys[at]
            hit = held == keys[rest]
            out[rest[hit]] = self.values[at[hit]]
            go = ~hit & (held != -1)
            rest, at = rest[go], (at[go] + 1) & mask
        return out


def word_bounds(low: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words in lowered bytes; no word crosses a position in ``cuts``."""
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low != 0
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cuts = cuts[(cuts > 0) & (cuts < len(low))]
    crossed = cuts[inside[1:-1][cuts] & inside[1:-1][cuts - 1]]
    first[crossed] = True
    last[crossed - 1] = True
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Automaton:
    """The automaton of some contents, compiled to arrays.

    ``contents`` are distinct pairs of word lists and the names of the items that consist of them.
    """

    def __init__(self, contents: list[tuple[list[bytes], list[str]]], window: int = WINDOW):
        self.window = window
        self.names = [names for _, names in contents]
        number: dict[bytes, int] = {}
        lines = [[number.setdefault(w, len(number)) for w in words] for words, _ in contents]
        self._number_words(list(number))
        steps, self.link, self.length = self._states(lines)
        keys = np.array([s << 32 | w for s, row in enumerate(steps) for w in row if s], np.int64)
        goals = np.array([q for s, row in enumerate(steps) for q in row.values() if s], np.int32)
        self.steps = Slots(keys, goals)
        self.from_root = np.zeros(len(number), np.int32)
        for word, goal in steps[0].items():
            self.from_root[word] = goal
        self._places(lines, steps)
        longest = max(map(len, lines), default=0)
        self.reach = max(window, min(REACH, longest))

    def packed(self) -> bytes:
        """The arrays alone, which any worker can read."""
        return pickle.dumps(
            {k: ("slots", v.__dict__) if isinstance(v, Slots) else (None, v) for k, v in self.__dict__.items()}
        )

    @classmethod
    def unpacked(cls, data: bytes) -> Automaton:
        out = cls.__new__(cls)
        for name, (kind, value) in pickle.loads(data).items():
            if kind:
                slots = Slots.__new__(Slots)
                slots.__dict__.update(value)
                value = slots
            setattr(out, name, value)
        return out

    # Words ------------------------------------------------------------------------------------

    def _number_words(self, words: list[bytes]) -> None:
        sizes = np.array([len(w) for w in words], np.int64)
        self.word_ends = np.cumsum(sizes)
        self.word_starts = self.word_ends - sizes
        self.word_bytes = np.frombuffer(b"".join(words), np.uint8)
        self.longest_word = int(sizes.max()) if len(words) else 0
        factor = 0x100000001B3
        while True:  # until no two words of the items share a code
            powers = np.full(max(1, self.longest_word), factor, np.uint64)
            powers[0] = 1
            self.powers = np.cumprod(powers)
            codes = self.codes(self.word_bytes, self.word_starts, sizes)
            if len(np.unique(codes)) == len(words):
                break
            factor += 2
        self.words = Slots(codes, np.arange(len(words), dtype=np.int32))

    def codes(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A number per word laid end to end in ``data``."""
        if not len(starts):
            return np.zeros(0, np.int64)
        place = np.arange(len(data)) - np.repeat(starts, sizes)
        mixed = (data.astype(np.uint64) + np.uint64(1)) * self.powers[place]
        code = np.add.reduceat(mixed, starts) * np.uint64(0x9E3779B97F4A7C15)
        code ^= (code >> np.uint64(31)) + sizes.astype(np.uint64)
        return (code >> np.uint64(1)).astype(np.int64)

    def numbers(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words that no item has.  Found words are compared whole."""
        sizes = ends - starts
        out = np.full(len(starts), -1, np.int32)
        short = np.flatnonzero(sizes <= self.longest_word)
        if not len(short):
            return out
        sizes = sizes[short]
        own = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(own, sizes)
        data = low[np.repeat(starts[short], sizes) + place]
        found = self.words.get(self.codes(data, own, sizes))
        hit = found >= 0
        hit[hit] = (self.word_ends - self.word_starts)[found[hit]] == sizes[hit]
        spread = np.repeat(hit, sizes)
        theirs = self.word_bytes[np.repeat(self.word_starts[found[hit]], sizes[hit]) + place[spread]]
        wrong = np.repeat(np.flatnonzero(hit), sizes[hit])[theirs != data[spread]]
        found[~hit] = -1
        found[wrong] = -1
        out[short] = found
        return out

    # States -----------------------------------------------------------------------------------

    @staticmethod
    def _states(lines: list[list[int]]):
        steps: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def copy(p: int, word: int, q: int) -> int:
            clone = len(steps)
            steps.append(dict(steps[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            while p >= 0 and steps[p].get(word) == q:
                steps[p][word] = clone
                p = link[p]
            link[q] = clone
            return clone

        for line in lines:
            last = 0
            for word in line:
                q = steps[last].get(word)
                if q is not None:
                    last = q if length[q] == length[last] + 1 else copy(last, word, q)
                    continue
                fresh = len(steps)
                steps.append({})
                link.append(0)
                length.append(length[last] + 1)
                p = last
                while p >= 0 and word not in steps[p]:
                    steps[p][word] = fresh
                    p = link[p]
                if p >= 0:
                    q = steps[p][word]
                    link[fresh] = q if length[q] == length[p] + 1 else copy(p, word, q)
                last = fresh
        return steps, np.array(link, np.int32), np.array(length, np.int32)

    def _places(self, lines: list[list[int]], steps: list[dict[int, int]]) -> None:
        """Per state: where its suffix of ``window`` words lives, and the contents found there."""
        states = len(self.length)
        up = self.link.tolist()
        size = self.length.tolist()
        anchor = np.full(states, -1, np.int32)
        for s in np.argsort(self.length, kind="stable").tolist():
            if size[s] >= self.window:
                anchor[s] = s if size[up[s]] < self.window else anchor[up[s]]
        whole: dict[int, set[int]] = {}
        brief: dict[int, set[tuple[int, int]]] = {}
        for content, line in enumerate(lines):
            state = 0
            for at, word in enumerate(line, 1):
                state = steps[state][word]
                if at >= self.window:
                    whole.setdefault(int(anchor[state]), set()).add(content)
            if 0 < len(line) < self.window:
                brief.setdefault(state, set()).add((len(line), content))
        self.anchor = anchor
        self.whole = {s: sorted(found) for s, found in whole.items()}
        self.brief = {s: sorted(found) for s, found in brief.items()}
        # The nearest state up the links, itself included, that ends a short item; 0 where none does.
        nearest = np.zeros(states, np.int32)
        for s in np.argsort(self.length, kind="stable").tolist():
            nearest[s] = s if s in brief else (nearest[up[s]] if s else 0)
        self.nearest = nearest

    # Streams ----------------------------------------------------------------------------------

    def stream(self, words: np.ndarray, fresh: np.ndarray, before: np.ndarray):
        """State and matched length after each word.

        ``fresh`` marks the first words of texts; ``before`` holds words of the first text that come
        before ``words``, as many as ``reach`` if there are.
        """
        n, reach = len(words), self.reach
        lanes = -(-n // LANE)
        padded = np.full(reach + lanes * LANE, -1, np.int32)
        padded[reach - len(before) : reach] = before
        padded[reach : reach + n] = words
        opens = np.zeros(len(padded), bool)
        opens[reach : reach + n] = fresh
        all_states = np.zeros(lanes * LANE, np.int32)
        all_lengths = np.zeros(lanes * LANE, np.int32)
        state, matched = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        for step in range(LANE + reach):
            word = padded[step::LANE][:lanes]
            held = np.flatnonzero((word >= 0) & (state > 0) & ~opens[step::LANE][:lanes])
            at, size, own = state[held], matched[held], word[held]
            known = word >= 0
            state = np.where(known, self.from_root[np.where(known, word, 0)], 0).astype(np.int32)
            matched = known.astype(np.int32)
            while len(held):
                goal = self.steps.get(at.astype(np.int64) << 32 | own)
                hit = goal >= 0
                state[held[hit]] = goal[hit]
                matched[held[hit]] = size[hit] + 1
                at = self.link[at]
                more = ~hit & (at > 0)
                held, at, own = held[more], at[more], own[more]
                size = self.length[at]
            if step >= reach:
                all_states[step - reach :: LANE] = state
                all_lengths[step - reach :: LANE] = matched
        return all_states[:n], all_lengths[:n]


class Found:
    """What was found in one text so far."""

    __slots__ = ("words", "longest", "spans", "contents", "tail")

    def __init__(self):
        self.words, self.longest = 0, 0
        self.spans: list[tuple[int, int]] = []
        self.contents: set[int] = set()
        self.tail = np.zeros(0, np.int32)

    def merged(self) -> list[tuple[int, int]]:
        return merge_spans(self.spans)


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def pieces(raw: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[list[tuple[int, int, int]]]:
    """Rows packed to lists of (row, from, to) of about ``size`` bytes.

    A row longer than that is cut between words; what follows a cut opens the next list.
    """
    pack, held = [], 0
    for row in range(len(offsets) - 1):
        at, end = int(offsets[row]), int(offsets[row + 1])
        if pack and held + (end - at) > size:
            yield pack
            pack, held = [], 0
        while end - at > size:
            stop = at + size
            while stop < end:  # the next byte outside words
                outside = np.flatnonzero(LOWERING[raw[stop : min(end, stop + 4096)]] == 0)
                if len(outside):
                    stop += int(outside[0])
                    break
                stop = min(end, stop + 4096)
            yield [(row, at, stop)]
            at = stop
        pack.append((row, at, end))
        held += end - at
    if pack:
        yield pack


def search(automaton: Automaton, raw: np.ndarray, offsets: np.ndarray, size: int = SLICE):
    """A ``Found`` per row."""
    found = [Found() for _ in range(len(offsets) - 1)]
    for pack in pieces(raw, offsets, size):
        low = LOWERING[raw[pack[0][1] : pack[-1][2]]]
        bounds = np.array([a for _, a, _ in pack], np.int64) - pack[0][1]
        starts, ends = word_bounds(low, bounds)
        opening = found[pack[0][0]]
        upto = np.append(np.searchsorted(starts, bounds), len(starts))
        words = automaton.numbers(low, starts, ends)
        fresh = np.zeros(len(words), bool)
        fresh[upto[1:-1][upto[1:-1] < len(words)]] = True
        states, lengths = automaton.stream(words, fresh, opening.tail)
        # Word positions count within the text: words of its earlier pieces come first.
        base = np.array([found[row].words for row, _, _ in pack], np.int64) - upto[:-1]
        for k, (row, _, _) in enumerate(pack):
            mine = found[row]
            mine.words += int(upto[k + 1] - upto[k])
            if upto[k + 1] > upto[k]:
                mine.longest = max(mine.longest, int(lengths[upto[k] : upto[k + 1]].max()))
        last = found[pack[-1][0]]
        own = words[upto[-2] :]
        last.tail = np.append(last.tail, own)[-automaton.reach :] if automaton.reach else own[:0]
        _collect(automaton, states, lengths, upto, base, [row for row, _, _ in pack], found)
    return found


def _collect(automaton, states, lengths, upto, base, rows, found) -> None:
    """Turn states into spans of words and contents of the rows."""
    window = automaton.window
    hits = np.flatnonzero(lengths >= window)
    if len(hits):
        part = np.searchsorted(upto, hits, side="right") - 1
        breaks = np.flatnonzero((np.diff(hits) > 1) | (np.diff(part) > 0)) + 1
        for a, b in zip([0, *breaks], [*breaks, len(hits)], strict=True):
            k = int(part[a])
            mine = found[rows[k]]
            low, high = int(hits[a] + base[k]), int(hits[b - 1] + base[k])
            mine.spans.append((low - window + 1, high + 1))
            for anchor in set(automaton.anchor[states[hits[a:b]]].tolist()):
                mine.contents.update(automaton.whole[anchor])
    if automaton.brief:
        near = automaton.nearest[states]
        at = np.flatnonzero(near)
        part = np.searchsorted(upto, at, side="right") - 1
        for i, k in zip(at.tolist(), part.tolist(), strict=True):
            mine, state, length = found[rows[k]], int(near[i]), int(lengths[i])
            while state:
                for size, content in automaton.brief[state]:
                    if size <= length:
                        place = int(i + base[k])
                        mine.spans.append((place - size + 1, place + 1))
                        mine.contents.add(content)
                state = int(automaton.nearest[automaton.link[state]])


# Spark ------------------------------------------------------------------------------------------

MATCH = (
    "n_words long, longest_match int, spans array<struct<start: int, end: int>>, items array<string>"
)
MATCH_TYPES = [
    pa.int64(), pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
    pa.list_(pa.string()),
]


def normal(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def automata(
    items: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    window: int = WINDOW,
    part_words: int = PART_WORDS,
) -> list[bytes]:
    """The packed automata of all items, one per part; none without a word in any item."""
    words = F.regexp_extract_all(normal(F.col(text_col)), F.lit(WORDS), F.lit(0))
    lines = items.select(F.col(id_col).cast("string").alias("item"), words.alias("words")).where(
        F.size("words") > 0
    )
    total = lines.agg(F.sum(F.size("words"))).first()[0]
    if not total:
        return []
    parts = -(-int(total) // part_words)
    cut = F.transform(
        F.sequence(F.lit(0), F.size("words") - 1, F.lit(PIECE_WORDS)),
        lambda s: F.array_join(F.slice("words", s + 1, F.lit(PIECE_WORDS + window - 1)), " "),
    )
    contents = lines.select("item", F.explode(cut).alias("content"))
    # What a cut leaves behind may be shorter than a window; all of it lies in the piece before.
    first = lines.select("item", F.array_join(F.slice("words", 1, PIECE_WORDS + window - 1), " "))
    full = contents.where(F.size(F.split("content", " ")) >= window).unionByName(
        first.toDF("item", "content")
    )
    dealt = full.distinct().withColumn("part", F.pmod(F.xxhash64("content"), F.lit(parts)))

    def build(table: pa.Table) -> pa.Table:
        named: dict[str, set] = {}
        for content, item in zip(
            table["content"].to_pylist(), table["item"].to_pylist(), strict=True
        ):
            named.setdefault(content, set()).update([item] if item is not None else [])
        made = Automaton([(c.encode().split(b" "), sorted(n)) for c, n in sorted(named.items())], window)
        return pa.table({"made": pa.array([made.packed()], pa.binary())})

    # One part holds about part_words words, whatever the number of items is.
    made = dealt.groupBy("part").applyInArrow(build, "made binary")
    return [bytes(row.made) for row in made.toLocalIterator()]


def _searcher(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton.unpacked(shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, offsets = bytes_of(batch.column("__raw").fill_null(b""))
            found = search(automaton, raw, offsets)
            columns = [
                [f.words for f in found],
                [f.longest for f in found],
                [[{"start": a, "end": b} for a, b in f.merged()] for f in found],
                [sorted({n for c in f.contents for n in automaton.names[c]}) for f in found],
            ]
            made = [pa.array(c, t) for c, t in zip(columns, MATCH_TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *made],
                names=[*names, "n_words", "longest_match", "spans", "items"],
            )

    return run


def mark(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    part_words: int = PART_WORDS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, n_words, longest_match, spans, items, n_hit; ``carry`` in the struct ``row``.

    ``spans`` are runs of hit words, from ``start`` up to and without ``end``, and ``items`` the ids
    of the items with a window in the text, as strings in order.  ``longest_match`` counts words that
    stand in an item in a row; beyond ``REACH`` it may be lower, never below ``REACH``.  Null and
    empty texts have no words.  Items of one content count under each of their ids; items without an
    id hit words but are not listed; items without a word never occur.  Every row gives one row,
    repeated rows and ids too.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("binary").alias("__raw"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    )
    kept = [f for f in base.schema.fields if f.name != "__raw"]
    names = [f.name for f in kept]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    made = automata(items, item_col, item_text_col, window, part_words)
    if len(made) == 1:
        marked = base.mapInArrow(_searcher(spark.sparkContext.broadcast(made[0]), names), f"{ddl}, {MATCH}")
    else:
        marked = _by_parts(base, made, names)
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return marked.withColumn("n_hit", length)


def _by_parts(base: DataFrame, made: list[bytes], names: list[str]) -> DataFrame:
    """Hits of every part by content, merged, and joined with the rows by content again."""
    spark = base.sparkSession
    key = F.sha2("__raw", 256)
    counted = F.coalesce(
        F.regexp_count(normal(F.col("__raw").cast("string")), F.lit(WORDS)), F.lit(0)
    ).cast("long")
    rows = base.select(*names, key.alias("__key"), counted.alias("n_words"))
    empty = F.expr("cast(array() as array<struct<start: int, end: int>>)")
    no_items = F.expr("cast(array() as array<string>)")
    if not made:
        return rows.select(
            *names, "n_words", F.lit(0).alias("longest_match"), empty.alias("spans"),
            no_items.alias("items"),
        )
    hits = None
    for payload in made:
        shared = spark.sparkContext.broadcast(payload)
        part = (
            base.select(key.alias("__key"), "__raw")
            .mapInArrow(_searcher(shared, ["__key"]), f"__key string, {MATCH}")
            .where(F.size("spans") > 0)
            .groupBy("__key")  # copies of a text have the same hits: one row of each is enough
            .agg(*[F.first(c).alias(c) for c in ("longest_match", "spans", "items")])
        )
        hits = part if hits is None else hits.unionByName(part)
    # At most one row a part and content from here on.
    merged = hits.groupBy("__key").agg(
        F.max("longest_match").alias("longest_match"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = rows.join(merged, "__key", "left").select(
        *names, "n_words",
        F.coalesce("longest_match", F.lit(0)).alias("longest_match"),
        F.coalesce("spans", empty).alias("spans"),
        F.coalesce("items", no_items).alias("items"),
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields)

    def join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"start": a, "end": b} for a, b in merge_spans((s["start"], s["end"]) for s in row)]
                for row in batch.column("spans").to_pylist()
            ]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["spans"] = pa.array(spans, MATCH_TYPES[2])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return joined.mapInArrow(join_spans, fields)


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match."""
    found = mark(docs, items, **options)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "longest_match",
    )


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    shortest: int = WINDOW,
    coverage: float = 0.5,
    **options,
) -> DataFrame:
    """The rows of ``docs`` without their contaminated spans.

    Runs of at least ``shortest`` hit words are cut out of the text, from the first letter of their
    first word to the last of their last.  Rows in which more than ``coverage`` of the words are hit
    go altogether.  Rows without a hit stay as they are.
    """
    found = mark(docs, items, text_col=text_col, carry=tuple(docs.columns), **options)
    kept = found.where(F.col("n_hit") <= F.lit(coverage) * F.col("n_words")).select(
        "row.*", F.filter("spans", lambda s: s["end"] - s["start"] >= shortest).alias("__spans")
    )
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_col)
            spans = batch.column("__spans").to_pylist()
            if any(spans):
                texts = [
                    cut_words(text.as_py(), [(s["start"], s["end"]) for s in own]) if own else text.as_py()
                    for text, own in zip(column, spans, strict=True)
                ]
                column = pa.array(texts, column.type)
            columns = [column if n == text_col else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(cut, ddl)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    raw = text.encode()
    starts, ends = word_bounds(LOWERING[np.frombuffer(raw, np.uint8)], np.zeros(0, np.int64))
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*out, raw[at:]]).decode()
