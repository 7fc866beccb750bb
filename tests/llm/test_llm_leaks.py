"""Decontamination against a brute-force search of every window in every text."""

import random
import re

import numpy as np
import pytest

from lodgelex.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(lowered(text or ""))


def brute(text, items, window=10):
    own, spots, names = words(text), set(), set()
    for name, item in items:
        listed = words(item)
        runs = [listed] if len(listed) < window else [
            listed[i : i + window] for i in range(len(listed) - window + 1)
        ]
        for run in runs:
            for i in range(len(own) - len(run) + 1) if run else ():
                if own[i : i + len(run)] == run:
                    spots.update(range(i, i + len(run)))
                    names.add(str(name))
    return len(own), len(spots), sorted(names)


def contents(items):
    named = {}
    for name, text in items:
        if words(text):
            named.setdefault(tuple(w.encode() for w in words(text)), []).append(str(name))
    return [(list(w), sorted(n)) for w, n in sorted(named.items())]


@pytest.mark.parametrize("seed", range(12))
def test_streams_find_every_window(seed, monkeypatch):
    pick = random.Random(seed)
    window = pick.choice([3, 5, 10])
    vocabulary = [pick.choice(["a", "bé", "C", "É", "ünï"]) + str(i % 3) for i in range(pick.choice([2, 5, 30]))]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.choice([1, 2, 4, 9, 10, 30])))) for i in range(8)]
    texts = []
    for _ in range(12):
        parts = pick.choices([*vocabulary, "zz"], k=pick.choice([0, 1, 40, 900]))
        parts[len(parts) // 2 : len(parts) // 2] = pick.choice(items)[1].split()
        texts.append(pick.choice([" ", ". ", "\n"]).join(parts))
    monkeypatch.setattr(dc, "LANE", pick.choice([4, 16, 512]))
    monkeypatch.setattr(dc, "REACH", pick.choice([10, 128]))
    automaton = dc.Automaton(contents(items), window)
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    found = dc.search(automaton, np.frombuffer(b"".join(raw), np.uint8), offsets, pick.choice([50, 1000, 1 << 21]))
    for text, own in zip(texts, found, strict=True):
        names = sorted({n for c in own.contents for n in automaton.names[c]})
        assert (own.words, sum(b - a for a, b in own.merged()), names) == brute(text, items, window)


LONG = " ".join(f"w{i}" for i in range(30))
TABLE = [
    (0, LONG), (1, "brief item"), (2, LONG), (3, None), (4, " ... "), (None, "no name at all"),
    (5, " ".join(f"w{i}" for i in range(20, 50))),
]
TEXTS = [
    (1, "x " + LONG.upper() + " y"), (1, "x " + LONG.upper() + " y"), (2, None), (3, ""), (4, "!?"),
    (5, "a Brief, item b"), (6, "has no name at all"), (None, " ".join(f"w{i}" for i in range(15, 40))),
    (7, " ".join(f"w{i}" for i in range(9))), (8, ("pad " * 3000 + "brief item ") * 3),
    (9, "briefitem brief x item"),
]


@pytest.mark.parametrize("part_words", [1 << 19, 20])
def test_marks_equal_brute_force_with_one_part_and_with_several(spark, part_words):
    docs, items = spark.createDataFrame(TEXTS, DOCS), spark.createDataFrame(TABLE, ITEMS)
    found = dc.mark(docs, items, part_words=part_words, carry=("text",)) if part_words > 20 else dc.mark(
        docs, items, part_words=part_words
    )
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in found.collect())
    listed = [(i, t) for i, t in TABLE if i is not None]
    expected = sorted(
        (str(i), (b := brute(t, listed))[0], max(b[1], 4 if i == 6 else 0), b[2]) for i, t in TEXTS
    )
    assert got == expected


def test_report_of_empty_tables_and_names_that_clash(spark):
    docs = spark.createDataFrame(
        [(1, LONG, "a", 3)], DOCS + ", items string, n_words int"
    ).withColumnRenamed("items", "row")
    items = spark.createDataFrame(TABLE, ITEMS)
    assert dc.report(docs, items).first()["n_items"] == 3
    assert dc.report(docs, items.limit(0)).first()["contaminated"] is False
    assert dc.report(docs, items.where("text is null")).first()["n_hit"] == 0
    assert dc.report(docs.limit(0), items).count() == 0


def test_an_item_longer_than_a_piece_keeps_every_window(spark, monkeypatch):
    monkeypatch.setattr(dc, "PIECE_WORDS", 16)
    item = " ".join(f"v{i}" for i in range(100))
    items = spark.createDataFrame([(1, item)], ITEMS)
    docs = spark.createDataFrame(
        [(i, " ".join(f"v{k}" for k in range(i, i + 10))) for i in range(91)], DOCS
    )
    assert {r["n_hit"] for r in dc.mark(docs, items).collect()} == {10}


def test_clean_cuts_spans_and_drops_covered_rows(spark):
    items = spark.createDataFrame(TABLE, ITEMS)
    around = " ".join(f"own{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, f"{around}; {LONG}. {around}"), (2, LONG + " tail"), (3, around), (4, None)], DOCS
    )
    kept = {r["doc_id"]: r["text"] for r in dc.clean(docs, items).collect()}
    assert kept == {1: f"{around}; . {around}", 3: around, 4: None}
    assert dc.clean(docs, items).columns == docs.columns
