"""Exact dedup, n-gram join, components and mixing against brute force and on edge rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodgelex.llm import exact_dedup, mixing, ngram_join
from lodgelex.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, row string"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, extra columns with clashing names."""
    rows = [
        (1, "Same Text here now", "en", "a", 4, 7, "x"), (2, "same text HERE now", None, "b", 4, 7, "x"),
        (3, None, "en", None, None, None, None), (4, "", "en", "a", 0, 1, "y"),
        (5, " \t\n", "en", "a", 3, 1, "y"), (6, "ÄÖ same", "de", "a", 7, 1, "y"),
        (7, "äö same", "de", "a", 7, 1, "y"), (8, "one", "en", "b", 3, 1, "y"),
        (8, "one", "en", "b", 3, 1, "y"), (None, "one", "en", "b", 3, 1, "y"),
        (None, None, None, None, None, None, None), (9, "word " * 30_000, "en", "c", 150_000, 1, "z"),
        (10, "two words", "en", "c", 9, 1, "z"), (11, "TWO\x0bwords", "en", "c", 9, 1, "z"),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def check_dedup(rows, found):
    groups = defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(LOWER)].append(key)
    assert len(found) == len(rows)
    by_hash = defaultdict(list)
    for r in found:
        by_hash[r["text_sha256"]].append(r)
    assert set(by_hash) == {hashlib.sha256(t.encode()).hexdigest() for t in groups}
    for text, keys in groups.items():
        mine = by_hash[hashlib.sha256(text.encode()).hexdigest()]
        best = max((k for k in keys if k is not None), default=None)
        assert Counter(r["doc_id"] for r in mine) == Counter(keys)
        assert {(r["keep_id"], r["group_size"]) for r in mine} == {(best, len(keys))}
        assert [r["doc_id"] for r in mine if r["kept"]] == [best]


def test_dedup_edge_rows(odd):
    check_dedup(texts(odd), exact_dedup.deduplicate(odd).collect())


@pytest.mark.parametrize("table_bytes, window_bytes", [(64, 256), (1 << 20, 64)])
def test_dedup_through_spill_files(spark, table_bytes, window_bytes):
    draw = random.Random(3)
    rows = [(i, draw.choice(["Aa", "aA"]) * draw.randint(0, 40)) for i in range(900)]
    rows += [(1000 + i, "hot text") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = exact_dedup.deduplicate(df, table_bytes=table_bytes, window_bytes=window_bytes)
    check_dedup(rows, found.collect())


def test_equal_digests_are_told_apart_by_content():
    table = exact_dedup.ContentTable(slots=2)
    same = b"\0" * 32
    numbers = [table.find(same, c) for c in (b"a", b"b", b"a", b"c", b"b", b"")]
    assert numbers == [0, 1, 0, 2, 1, 3]


@pytest.mark.parametrize("options", [{}, {"table_bytes": 40, "window_bytes": 64}])
def test_dedup_survivors_keep_columns(odd, options):
    kept = exact_dedup.survivors(odd, **options)
    assert kept.schema == odd.schema
    best = {}
    for key, text in texts(odd):
        name = (text or "").translate(LOWER)
        best[name] = max([k for k in (best.get(name), key) if k is not None], default=None)
    got = kept.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(best.values())
    source = {tuple(r) for r in odd.collect()}
    assert all(tuple(r) in source for r in got)


@pytest.mark.parametrize("work", [
    exact_dedup.deduplicate, exact_dedup.survivors, mixing.mix, mixing.mixture,
    ngram_join.linked_components, ngram_join.survivors,
])
def test_empty_table(spark, work):
    assert work(spark.createDataFrame([], SCHEMA)).collect() == []


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_components(rows, width, percent):
    sets = [shingles(text, width) for _, text in rows]
    above = list(range(len(rows)))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= percent * len(a | sets[j]):
                above[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids, default=None)) for i in members]
    return Counter(out)


def found_components(df, **options):
    rows = ngram_join.linked_components(df, **options).collect()
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


def test_join_edge_rows(odd):
    assert found_components(odd) == brute_components(texts(odd), 3, 90)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_join_near_copies(spark, width, percent):
    """A large family of near copies around a base, chains, frequent passages, noise."""
    draw = random.Random(width)
    vocabulary = [f"w{i}" for i in range(400)]
    frequent = " ".join(draw.choice(vocabulary[:20]) for _ in range(15))
    rows = []

    def noisy(words, changes):
        words = list(words)
        for _ in range(changes):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        return " ".join(words)

    base = [draw.choice(vocabulary) for _ in range(150)]
    rows += [noisy(base, draw.randint(0, 9)) for _ in range(120)]
    chain = [draw.choice(vocabulary) for _ in range(90)]
    for _ in range(30):
        chain = noisy(chain, 1).split()
        rows.append(" ".join(chain))
    rows += [frequent + " " + noisy(base[:20], 20) for _ in range(60)]
    rows += [noisy(base[: draw.randint(1, 30)], 4) for _ in range(80)]
    draw.shuffle(rows)
    rows = [(i, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_components(rows, width, percent)
    assert found_components(df, width=width, percent=percent) == want
    assert len({c for _, _, c in want}) < len(rows)
    kept = ngram_join.survivors(df, width=width, percent=percent)
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in want}


def test_join_rows_without_ids(spark):
    """A third of the rows has no id, copies among them; texts are found by what they hold."""
    draw = random.Random(12)
    base = [[draw.choice("abcdefghijklmnop") + str(draw.randint(0, 40)) for _ in range(60)] for _ in range(8)]
    rows = []
    for i in range(240):
        words = list(base[i % 8])
        words[draw.randrange(60)] = f"x{draw.randint(0, 3)}"
        rows.append((None if i % 3 == 0 else i, " ".join(words)))
    rows += [(None, rows[0][1])] * 20 + [(None, "only here " * 9), (None, "only here " * 9), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = ngram_join.linked_components(df, width=3, percent=80)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == (
        brute_components(rows, 3, 80)
    )


def test_parity_sketch_never_exceeds_the_difference():
    draw = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(draw.integers(0, 1 << 62, 300).astype(np.uint64))
        b = np.unique(np.concatenate([a[draw.random(len(a)) < 0.9], draw.integers(0, 1 << 62, 20).astype(np.uint64)]))
        bits = ngram_join.parity_sketch(a).view(np.uint64) ^ ngram_join.parity_sketch(b).view(np.uint64)
        assert sum(int(x).bit_count() for x in bits) <= len(np.setxor1d(a, b))


def test_wide_sketches_of_different_widths():
    draw = np.random.default_rng(2)
    for size, more in ((3000, 500), (4090, 20), (5000, 3000), (70_000, 9000)):
        a = np.unique(draw.integers(0, 1 << 62, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: -size // 20], draw.integers(0, 1 << 62, more).astype(np.uint64)]))
        bits = ngram_join.differing_bits(ngram_join.wide_sketch(a), ngram_join.wide_sketch(b))
        assert 0 < bits <= len(np.setxor1d(a, b))
    assert ngram_join.wide_sketch(a[:2048]) is None


def test_wide_sketches_refuse_pairs(spark):
    draw = np.random.default_rng(3)
    left = np.unique(draw.integers(0, 1 << 62, 3000).astype(np.uint64))
    near = np.unique(np.concatenate([left[:2900], draw.integers(0, 1 << 62, 100).astype(np.uint64)]))
    other = np.unique(draw.integers(0, 1 << 62, 3000).astype(np.uint64))
    small = [np.unique(draw.integers(0, 1 << 62, 300).astype(np.uint64))]
    sets = [left, near, other, *small, small[0][:290]]
    rows = [(i, len(s), ngram_join.parity_sketch(s).tolist(), ngram_join.wide_sketch(s)) for i, s in enumerate(sets)]
    sketched = spark.createDataFrame(rows, "sid long, n long, sketch array<long>, wide binary")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2), (3, 4)], "a long, b long")
    # The short sketches allow them all: they are full.
    n, sketches = [r[1] for r in rows], [np.array(r[2]).view(np.uint64) for r in rows]
    assert 180 * int(np.bitwise_count(sketches[0] ^ sketches[2]).sum()) <= 20 * (n[0] + n[2])
    got = ngram_join.plausible(pairs, sketched, 80)
    assert sorted(tuple(r) for r in got.select("a", "b").collect()) == [(0, 1), (3, 4)]


def test_join_of_long_texts(spark):
    draw = random.Random(9)
    base = [f"w{draw.randint(0, 5000)}" for _ in range(4500)]
    rows = []
    for i, changes in enumerate((0, 40, 80, 120, 200, 400, 900)):
        words = list(base)
        for _ in range(changes):
            words[draw.randrange(len(words))] = f"v{draw.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(10 + i, " ".join(base[i * 5 : i * 5 + 3000])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found_components(df) == brute_components(rows, 3, 90)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    links += [(90, 80), (80, 70), (95, 90)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {70: 70, 80: 70, 90: 70, 95: 70}
    assert {r["node"]: r["component"] for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def fill_up(sizes, weights, share=1.5, limit=2.0):
    """Targets by sharing the excess again and again."""
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        rest = total - sum(fixed.values())
        part = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if part[s] > limit * sizes[s] + 1e-9]
        if not over:
            return fixed | part
        fixed |= {s: limit * sizes[s] for s in over}


def test_mix_targets_and_taken(spark):
    draw = random.Random(5)
    names = ["b", "a", "é", "Z", None, "zz"]
    rows = [
        (i, " ".join(["w"] * draw.randint(0, 30)), draw.choice(["a"] * 9 + names)) for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = fill_up(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] % max(1, r["size"]) == 0
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_prefers_quality(spark):
    rows = [(i, 10, "s", 4.0 if i % 2 else 0.25) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, size long, source string, q double")
    got = mixing.mix(df, size_col="size", quality_col="q", share=0.5, limit=2.0).collect()
    good = sum(r["taken"] for r in got if r["doc_id"] % 2)
    assert good > 8000 * 0.9 and sum(r["taken"] for r in got) == pytest.approx(10_000, abs=10)


def test_mix_edge_rows(odd):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count()
    assert {r["size"] for r in got if r["doc_id"] in (3, 4, 5)} == {0}
    assert mixing.mixture(odd).columns == odd.columns
