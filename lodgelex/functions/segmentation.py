"""Words of scripts that are written without spaces: a dictionary trie and the best path over runs.

All runs of a batch are walked and cut at once: what is looked up or added up is an array over them.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Blocks of scripts written without spaces (Han, kana, Thai, Lao, Khmer, Myanmar).
SPACELESS_RANGES = (
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF),
    (0x3041, 0x30FF), (0x31F0, 0x31FF), (0x0E01, 0x0E7F), (0x0E81, 0x0EFF), (0x1780, 0x17DD),
    (0x1000, 0x109F),
)
_CLASS = "".join(f"{chr(a)}-{chr(b)}" for a, b in SPACELESS_RANGES)
#: A run of such a script, and the parts of a token: runs and what stands between them.
RUN = f"[{_CLASS}]"
PARTS = f"[{_CLASS}]+|[^{_CLASS}]+"

#: What a character that no word covers costs beyond the rarest word, in thousandths.
UNKNOWN = 10_000
#: Characters that are walked and cut together.
TOGETHER = 1 << 20
#: Characters whose places are sieved together.
SIEVED = 1 << 16
#: Characters of the rows that are packed together.
PACKED = 1 << 21
#: Bits of a character's number.
SIGN = 21
#: Bits of the sieve that tells most texts that are no dictionary word, and of one block of it.
SIEVE_BITS, SIEVE_BLOCK = 1 << 27, 1 << 15
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def signs_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts as numbers, one text after another, and the length of each."""
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    whole = "".join(texts.to_pylist())
    return np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64), lengths


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def spaceless(signs: np.ndarray) -> np.ndarray:
    """Which characters belong to a script written without spaces."""
    inside = np.zeros(len(signs), bool)
    for low, high in SPACELESS_RANGES:
        inside |= (signs >= low) & (signs <= high)
    return inside


def best_cuts(lengths, run, start, size, cost, unknown: int) -> np.ndarray:
    """Where a piece begins on the cheapest path of every run, as flags over the runs' characters.

    Of equally cheap paths the one with the longer last word, from the end on.  ``run``, ``start``,
    ``size`` and ``cost`` list the dictionary words found in the runs.  A character may always stand
    alone at the cost ``unknown``.  One step of the loop is the same place in all runs.
    """
    first = starts_of(lengths + 1)
    longest = int(lengths.max(initial=0))
    order = np.argsort(-lengths, kind="stable")
    reaching = np.searchsorted(-lengths[order], -np.arange(longest + 1), side="right")
    begun = first[order]
    by_end = np.argsort(start + size, kind="stable")
    run, size, cost = run[by_end], size[by_end], cost[by_end]
    end = (start[by_end] + size).astype(np.int64)
    bounds = np.searchsorted(end, np.arange(longest + 2))
    to = first[run] + end
    # Cost above, size below and turned round: the smallest number is the cheapest and then longest.
    bits = int(size.max(initial=1) + 1).bit_length()
    last = (1 << bits) - 1
    paid = np.zeros(len(first) + int(lengths.sum()), np.int64)
    best = np.zeros_like(paid)
    for e in range(1, longest + 1):
        at = begun[: reaching[e]] + e
        best[at] = ((paid[at - 1] + unknown) << bits) | (last - 1)
        own = slice(bounds[e], bounds[e + 1])
        if own.start < own.stop:
            total = paid[to[own] - size[own]] + cost[own]
            np.minimum.at(best, to[own], (total << bits) | (last - size[own]))
        paid[at] = best[at] >> bits
    back = last - (best & last)
    begins = np.zeros(len(paid), bool)
    at, low = (first + lengths)[lengths > 0], first[lengths > 0]
    while len(at):
        at = at - back[at]
        begins[at] = True
        inner = at > low
        at, low = at[inner], low[inner]
    return np.delete(begins, first + lengths)


def best_path(run: str, words: Iterable[tuple[int, int, int]], unknown: int) -> list[str]:
    """The pieces of one run; ``words`` are (start, length, cost) of the dictionary words in it."""
    start, size, cost = np.array(list(words), np.int64).reshape(-1, 3).T
    lengths = np.array([len(run)])
    begins = np.flatnonzero(best_cuts(lengths, np.zeros_like(start), start, size, cost, unknown))
    return [run[a:b] for a, b in zip(begins, [*begins[1:], len(run)], strict=True)]


def pieces_of(texts: pa.Array, signs: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Non-empty ``texts``, one after another, cut before every flagged character."""
    width = 1 + (signs > 0x7F) + (signs > 0x7FF) + (signs > 0xFFFF)
    places = starts_of(width)[begins]
    raw = "".join(texts.to_pylist()).encode()
    offsets = np.append(places, len(raw)).astype(np.int32)
    return pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw))


class Trie:
    """Dictionary words as sorted edges (node, character); the edge at ``i`` leads to node ``i + 1``."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        lowest: dict[str, int] = {}
        for word, cost in words:
            if word:
                lowest[word] = min(cost, lowest.get(word, cost))
        signs, lengths = signs_of(pa.array(list(lowest), pa.string()))
        starts, node = starts_of(lengths), np.zeros(len(lengths), np.int64)
        levels, nodes = [], 1
        for depth in range(int(lengths.max(initial=0))):
            going = np.flatnonzero(lengths > depth)
            edges = (node[going] << SIGN) | signs[starts[going] + depth]
            level, which = np.unique(edges, return_inverse=True)
            node[going] = nodes + which
            levels.append(level)
            nodes += len(level)
        self.edges = np.concatenate(levels) if levels else np.zeros(0, np.int64)
        self.cost = np.full(nodes, -1, np.int64)
        self.cost[node] = list(lowest.values())

    def found(self, run: str) -> Iterable[tuple[int, int, int]]:
        """The words of one run by place, size and cost."""
        signs, _ = signs_of(pa.array([run], pa.string()))
        columns = self.walk(signs, np.full(len(signs), len(signs)))
        return list(zip(*(column.tolist() for column in columns), strict=True))

    def walk(self, signs: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places, sizes and costs of the words in ``signs``; the run at a character goes up to its
        ``ends``, and a character whose own place is its end is in no run."""
        at = np.flatnonzero(ends > np.arange(len(signs)))
        node, depth, out = np.zeros(len(at), np.int64), 0, []
        while len(at) and len(self.edges):
            edge = (node << SIGN) | signs[at + depth]
            place = np.searchsorted(self.edges, edge)
            known = self.edges[np.minimum(place, len(self.edges) - 1)] == edge
            at, node, depth = at[known], place[known] + 1, depth + 1
            cost = self.cost[node]
            word = cost >= 0
            out.append((at[word], np.full(int(word.sum()), depth), cost[word]))
            inner = at + depth < ends[at]
            at, node = at[inner], node[inner]
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def segmented_texts(texts: pa.Array, trie: Trie, unknown: int) -> tuple[pa.Array, np.ndarray]:
    """The pieces of non-empty ``texts``, one after another, and how many each text has.

    Runs are cut along their best path; what stands between them is one piece.
    """
    signs, lengths = signs_of(texts)
    starts = starts_of(lengths)
    begins = np.zeros(len(signs), bool)
    inside = spaceless(signs)
    begins[1:] = inside[1:] != inside[:-1]
    begins[starts] = True
    part = np.flatnonzero(begins)
    sizes = np.diff(part, append=len(signs))
    ends = np.where(inside, np.repeat(part + sizes, sizes), np.arange(len(signs)))
    runs = inside[part]
    at, size, cost = trie.walk(signs, ends)
    run = (np.cumsum(runs) - 1)[np.searchsorted(part, at, side="right") - 1]
    cuts = best_cuts(sizes[runs], run, at - part[runs][run], size, cost, unknown)
    begins[inside] = cuts
    return pieces_of(texts, signs, begins), np.add.reduceat(begins.astype(np.int64), starts)


def cut_together(texts: pa.Array, trie: Trie, alone: int) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts and how many each has; an empty text is its own piece."""
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.ones(len(texts), np.int64)
    full = np.flatnonzero(lengths)
    parts = [pa.array([], pa.string())]
    slices = np.flatnonzero(np.diff(np.cumsum(lengths[full]) // TOGETHER, prepend=0))
    for a, b in itertools.pairwise([0, *slices, len(full)]):
        if a < b:
            own, counts[full[a:b]] = segmented_texts(texts.take(pa.array(full[a:b])), trie, alone)
            parts.append(own)
    pieces = pa.concat_arrays(parts)
    if len(full) == len(texts):
        return pieces, counts
    at = np.full(int(counts.sum()), -1)
    at[np.repeat(lengths > 0, counts)] = np.arange(len(pieces))
    return pieces.take(pa.array(at, mask=at < 0)).fill_null(""), counts


def put_back(tokens: pa.Array, indices: pa.Array, pieces: pa.Array, counts: np.ndarray) -> pa.Array:
    """``tokens`` with the pieces of the different text at ``indices`` in the place of each token."""
    if indices.null_count:
        raise ValueError("a token is null")
    index = indices.to_numpy(zero_copy_only=False).astype(np.int64)
    many = counts[index]
    begin = (np.cumsum(counts) - counts)[index]
    ends = np.cumsum(many)
    at = np.arange(int(many.sum())) + np.repeat(begin - (ends - many), many)
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    offsets = np.append(0, ends)[np.append(0, np.cumsum(sizes))]
    values = pieces.take(pa.array(at))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pc.is_null(tokens))


def cut_rows(tokens: pa.Array, trie: Trie, alone: int) -> pa.Array:
    """The pieces of every row of tokens; each different token is cut once."""
    coded = pc.list_flatten(tokens).dictionary_encode()
    pieces, counts = cut_together(coded.dictionary.cast(pa.string()), trie, alone)
    return put_back(tokens, coded.indices, pieces, counts)


def _spread(sums: np.ndarray) -> np.ndarray:
    """Numbers below 2^63 that depend on every bit of ``sums``."""
    mixed = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(1)).view(np.int64)


def marks_of(texts: pa.Array) -> np.ndarray:
    """A number for every text: its characters as the digits of one long number, spread."""
    signs, lengths = signs_of(texts)
    starts, sums = starts_of(lengths), np.zeros(len(lengths), np.uint64)
    for depth in range(int(lengths.max(initial=0))):
        going = lengths > depth
        sums[going] = sums[going] * FACTOR + signs[starts[going] + depth].astype(np.uint64)
    return _spread(sums)


def sieve_of(blocks: Iterable[tuple[int, bytes]]) -> np.ndarray:
    """The bits of all blocks, eight in a byte."""
    sieve = np.zeros(SIEVE_BITS // 8, np.uint8)
    for block, bits in blocks:
        at = block * (SIEVE_BLOCK // 8)
        sieve[at : at + SIEVE_BLOCK // 8] = np.frombuffer(bits, np.uint8)
    return sieve


def sieved(signs: np.ndarray, ends: np.ndarray, sieve: np.ndarray, longest: int) -> tuple[np.ndarray, ...]:
    """Places, sizes and sums of what may be a word: all words of up to ``longest`` characters, and
    little else.

    The run at a character goes up to its ``ends``; a character whose own place is its end is in none.
    """
    at = np.flatnonzero(ends > np.arange(len(signs)))
    sums, out = np.zeros(len(at), np.uint64), []
    for depth in range(longest):
        sums = sums * FACTOR + signs[at + depth].astype(np.uint64)
        bit = _spread(sums) & (SIEVE_BITS - 1)
        may = (sieve[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
        out.append((at[may], np.full(int(may.sum()), depth + 1), sums[may]))
        inner = at + depth + 1 < ends[at]
        at, sums = at[inner], sums[inner]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), sums[:0]
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def one_of_each(signs: np.ndarray, at: np.ndarray, size: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """One place of each different text, and which of them every place holds."""
    _, first, which = np.unique(sums, return_index=True, return_inverse=True)
    to = at[first][which]
    same = size == size[first][which]
    for depth in range(int(size.max(initial=0))):
        on = np.flatnonzero((size > depth) & same)
        same[on] = signs[at[on] + depth] == signs[to[on] + depth]
    # Sums of different texts that agree: every place counts for itself.
    return (first, which) if same.all() else (np.arange(len(at)), np.arange(len(at)))


def words_held(tokens: pa.Array, sieve: np.ndarray, longest: int) -> pa.Array:
    """For every row of tokens the different texts in its runs that pass the sieve; null has none."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    texts = pc.list_flatten(tokens).cast(pa.string())
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    token_row = np.repeat(np.arange(len(tokens)), sizes)
    rows, words = [], [pa.array([], pa.string())]
    slices = np.flatnonzero(np.diff(np.cumsum(lengths) // SIEVED, prepend=0))
    for a, b in itertools.pairwise([0, *slices, len(texts)]):
        if a < b:
            whole, own = "".join(texts.slice(a, b - a).to_pylist()), lengths[a:b]
            signs = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64)
            owner = np.repeat(np.arange(a, b), own)
            inside = spaceless(signs)
            change = np.flatnonzero((inside[1:] != inside[:-1]) | (owner[1:] != owner[:-1])) + 1
            bounds = np.concatenate([[0], change, [len(signs)]]).astype(np.int64)
            ends = np.repeat(bounds[1:], np.diff(bounds))
            ends = np.where(inside, ends, np.arange(len(signs)))
            at, size, sums = sieved(signs, ends, sieve, longest)
            first, which = one_of_each(signs, at, size, sums)
            many = max(1, len(first))
            pair = np.unique(token_row[owner[at]] * many + which)
            met = [whole[x : x + n] for x, n in zip(at[first].tolist(), size[first].tolist(), strict=True)]
            rows.append(pair // many)
            words.append(pa.array(met, pa.string()).take(pa.array(pair % many)))
    # A row that two slices share may name a word twice, which changes no path.
    counts = np.bincount(np.concatenate([np.zeros(0, np.int64), *rows]), minlength=len(tokens))
    offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(words))


def different_words(tokens: pa.Array, sieve: np.ndarray, longest: int) -> pa.Array:
    """The different texts in the runs of all rows that pass the sieve."""
    texts = pc.unique(pc.list_flatten(tokens)).cast(pa.string())
    whole = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
    return pc.unique(pc.list_flatten(words_held(whole, sieve, longest)))


def packs_of(rows: pa.RecordBatch, name: str) -> Iterable[pa.RecordBatch]:
    """``rows`` in slices of about ``PACKED`` characters of the tokens in the column ``name``."""
    tokens = rows.column(name)
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.utf8_length(pc.list_flatten(tokens)).to_numpy(zero_copy_only=False).astype(np.int64)
    so_far = np.append(0, np.cumsum(lengths))[np.cumsum(sizes)]
    slices = np.flatnonzero(np.diff(so_far // PACKED, prepend=0))
    for a, b in itertools.pairwise([0, *slices, len(rows)]):
        if a < b:
            yield rows.slice(a, b - a)


def packed(rows: pa.RecordBatch) -> bytes:
    """``rows`` in Arrow's own form, each of its buffers compressed."""
    out = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(out, rows.schema, options=options) as stream:
        stream.write_batch(rows)
    return out.getvalue().to_pybytes()


def unpacked(raw: pa.Buffer) -> pa.Table:
    with pa.ipc.open_stream(raw) as stream:
        return stream.read_all()
