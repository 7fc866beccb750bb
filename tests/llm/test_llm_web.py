"""WARC, URL filter and top-k search on edge rows and against brute force."""

import base64
import hashlib
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgelex.llm import common, topk_search, url_filter, warc
from lodgelex.llm.common import scratch
from lodgelex.llm.queries import URL_RULES

PAGE_SCHEMA = "page_id long, url string, html string, payload string, of string, kind string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "p", "o", "k") for r in rows], PAGE_SCHEMA).repartition(3)


def check_archive(rows, got):
    firsts = {}
    for key, _, text in rows:
        if key is not None:
            firsts[text or ""] = min(key, firsts.get(text or "", key))
    want = Counter()
    for key, _, text in rows:
        raw, first = (text or "").encode(), firsts.get(text or "")
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        response = key == first
        want[(key, len(raw), digest, "response" if response else "revisit", None if response else first)] += 1
    assert Counter(
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["kind"], r["refers_to"]) for r in got
    ) == want


ROWS = [
    (5, "http://a/", "same"), (2, "http://b/", "same"), (9, None, "same"), (2, "http://b/", "same"),
    (1, "http://c/\r\nX: y", None), (3, "", ""), (None, "u", "alone"), (None, "u", "same"),
    (4, "http://d/", "WARC/1.1\r\n\r\n\x1f\x8b\x08 inside"), (6, "é", "ü" * 70_000),
]


def test_warc_round_trip(spark):
    got = warc.round_trip(pages_of(spark, ROWS), file_bytes=300).collect()
    check_archive(ROWS, got)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in got if r["kind"] == "response" and r["page_id"]}
    assert payloads[6] == ("ü" * 70_000).encode() and payloads[4] == ROWS[8][2].encode()
    assert warc.round_trip(pages_of(spark, ROWS).limit(0)).collect() == []


def test_warc_least_bytes(spark):
    got = warc.round_trip(pages_of(spark, ROWS), least_bytes=5).collect()
    assert {r["kind"] for r in got} == {"response"}


def archive(n=12, packed=True):
    parts = [warc.record(i, f"http://x/{i}", bytes([65 + i]) * (40 + i)) for i in range(n)]
    return [warc.member(p) if packed else p for p in parts]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "junk", "head", "tail"])
def test_salvage(packed, damage):
    parts = archive(packed=packed)
    broken = bytearray(parts[4])
    lost = {4}
    if damage == "flip":
        broken[len(broken) // 2 if packed else -20] ^= 0xFF
    elif damage == "cut":
        broken = broken[: len(broken) // 2]
    elif damage == "junk":
        broken, lost = bytearray(b"\x1f\x8b\x08junk WARC/1.1\r\n" + parts[4]), set()
    elif damage == "head":
        broken[:2] = b"??"
    data = b"".join([*parts[:4], bytes(broken), *parts[5:]])
    if damage == "tail":
        # Packed, the cut takes the member's trailer only: the record inside passes its own checks.
        data, lost = b"".join(parts)[:-9], set() if packed else {11}
    salvage = warc.Salvage(data)
    found = [warc.page_of(r.fields["warc-record-id"]) for r in salvage.records()]
    assert found == [i for i in range(12) if i not in lost]
    # Nothing of the packed tail is left to quarantine, but the cut is logged.
    assert len(salvage.gaps) == 1
    assert salvage.gaps[0].end > salvage.gaps[0].start or (packed and damage == "tail")
    read = sum(r.end - r.start for r in warc.Salvage(data).records())
    assert read + sum(g.end - g.start for g in salvage.gaps) == len(data)


def solid(n=6):
    return [warc.record(i, f"http://x/{i}", random.Random(i).randbytes(30_000 + i)) for i in range(n)]


def ids(salvage):
    return [warc.page_of(r.fields["warc-record-id"]) for r in salvage.records()]


def test_member_of_many_records_with_one_damaged():
    parts = solid()
    parts[2] = parts[2][:900] + bytes([parts[2][900] ^ 1]) + parts[2][901:]
    salvage = warc.Salvage(b"junk" + warc.member(b"".join(parts)))
    assert ids(salvage) == [0, 1, 3, 4, 5]
    inside, before = sorted(salvage.gaps, key=lambda g: g.inner_start is None)
    assert (inside.inner_start, inside.inner_end) == (len(parts[0] + parts[1]), len(b"".join(parts[:3])))
    assert "digest" in inside.reason and (before.start, before.end, before.inner_start) == (0, 4, None)


def test_member_of_many_records_with_wrong_checksum():
    broken = bytearray(warc.member(b"".join(solid())))
    broken[-6] ^= 0xFF
    salvage = warc.Salvage(bytes(broken) + warc.member(solid(8)[7]))
    assert ids(salvage) == [*range(6), 7]
    assert len(salvage.gaps) == 1 and salvage.gaps[0].end == len(broken)


@pytest.mark.parametrize("step", [1 << 14, 700])
def test_member_of_many_records_cut_or_flipped(monkeypatch, step):
    monkeypatch.setattr(warc, "STEP", step)
    whole, after = warc.member(b"".join(solid())), warc.member(solid(8)[7])
    for at in (50, 20_000, 100_000, len(whole) - 3):
        cut = warc.Salvage(whole[:at] + after)
        found = ids(cut)
        sound = sum(1 for i in range(6) if len(b"".join(solid()[: i + 1])) < at - 60)
        assert found[-1] == 7 and found[:-1] == list(range(len(found) - 1)) and len(found) > sound
        assert len(cut.gaps) == 1 and cut.gaps[0].end == at
        flipped = bytearray(whole)
        flipped[at] ^= 0x10
        one = warc.Salvage(bytes(flipped) + after)
        found = ids(one)
        assert found[-1] == 7 and found == sorted(set(found)) and len(found) > sound
        assert one.gaps


def test_records_without_digest_in_a_damaged_member_are_quarantined():
    bare = re.sub(rb"WARC-Block-Digest[^\r]*\r\n", b"", b"".join(solid()))
    whole = bytearray(warc.member(bare))
    assert len(ids(warc.Salvage(bytes(whole)))) == 6
    whole[-6] ^= 0xFF
    salvage = warc.Salvage(bytes(whole))
    assert ids(salvage) == [] and [(g.start, g.end) for g in salvage.gaps] == [(0, len(whole))]


def test_folder_without_a_scheme(spark):
    place = scratch(spark, "plain-path").removeprefix("file:")
    pages = pages_of(spark, ROWS)
    check_archive(ROWS, warc.read(spark, place, warc.write(pages, place, file_bytes=300)).collect())
    assert {r["kind"] for r in warc.read(spark, place).collect()} == {"response", "revisit"}


def test_scratch_is_named_and_released(spark):
    held = set(common.named())
    warc.round_trip(pages_of(spark, ROWS)).collect()
    made = [f for f in common.named() if f not in held]
    assert len(made) == 2 and all(os.path.isdir(f.removeprefix("file:")) for f in made)
    common.release(spark, made)
    assert not any(os.path.exists(f.removeprefix("file:")) for f in made)
    assert set(common.named()) == held


def test_salvage_of_junk_only():
    for data in (b"", b"nothing", b"WARC/1.1\r\n", b"\x1f\x8b\x08"):
        salvage = warc.Salvage(data)
        assert list(salvage.records()) == []
        assert [(g.start, g.end) for g in salvage.gaps] == ([(0, len(data))] if data else [])


def test_gaps_are_rows(spark):
    folder = scratch(spark, "warc-test").removeprefix("file:")
    fs, path = warc.pafs.FileSystem.from_uri(f"file://{folder}")
    fs.create_dir(path, recursive=True)
    parts = archive()
    with fs.open_output_stream(f"{path}/a.warc.gz", compression=None) as out:
        out.write(b"".join([*parts[:3], b"rubbish", *parts[3:]]))
    got = warc.read(spark, folder).collect()
    assert Counter(r["kind"] for r in got) == {"response": 12, "gap": 1}
    gap = next(r for r in got if r["kind"] == "gap")
    assert gap["end"] - gap["start"] == 7 and gap["reason"]


def judged(url):
    """Host, path and rule by hand."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, after = rest[:cut], rest[cut:]
        path = after[: min([after.index(c) for c in "?#" if c in after] or [len(after)])]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


def test_url_rules_and_trees(spark):
    draw = random.Random(8)
    urls = [None, "", "no scheme", "http://", "://x", "HTTP://WWW.Example.COM/en/a?b=/c#d", "ftp://example.com/en",
            "http://notexample.com/en/", "http://example.com?x", "http://a.net/es/#q", "x://ÉX.com/", "u://a.com//://b",
            "http://net/fr/", "http://x.org/\nnext/en/", "https://" + "a" * 9000 + ".org/" + "b/" * 9000]
    for _ in range(400):
        host = draw.choice(["www.example.com", "m.example.com", "q-1.net", "deep.w.org", "example.org", "z.com"])
        path = draw.choice(["/en/", "/es/", "/fr/", "/de/"])
        urls.append(f"https://{host}{path}{draw.randint(1, 999)}{draw.choice(['', '?a=1&b=2', '#top'])}")
    rows = [(i, u) for i, u in enumerate(urls)] + [(3, urls[3]), (None, urls[20])]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' as host", "1 as score", "'r' as ruled")
    got = url_filter.judge(df.repartition(3), URL_RULES).collect()
    again = url_filter.judge(df.repartition(5), URL_RULES).collect()
    assert len(got) == len(rows)
    assert Counter((r["page_id"], r["verdict"]) for r in got) == Counter((r["page_id"], r["verdict"]) for r in again)
    by_id = {r["page_id"]: r for r in got}
    for key, url in rows:
        r, (host, path, name, verdict) = by_id[key], judged(url)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
        assert 0 <= r["score"] <= 1


def test_url_filter_without_labels(spark):
    df = spark.createDataFrame([(1, "http://x.org/"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge(df, URL_RULES).collect()} == {"allow"}
    assert url_filter.judge(df.limit(0), URL_RULES).collect() == []


def brute_topk(rows, every, k):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    live = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q in sorted({i for i, _ in live if i % every == 0}):
        mine = min((v for i, v in live if i == q), key=lambda v: np.array(v, float).tobytes())
        scores = [(-sum(map(lambda a, b: a * b, mine, v)), i) for i, v in live if i != q and len(v) == len(mine)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def search_rows(spark, rows, every, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as bound", "'a' as id")
    got = topk_search.search(df.repartition(4), F.col("vec_id") % every == 0, **options).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.mark.parametrize("options", [{}, {"block_rows": 60, "centres": 7, "part_rows": 9}])
def test_topk(spark, options):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 8))
    points = [centres[draw.integers(6)] + 0.2 * draw.normal(size=8) for _ in range(500)]
    points += [points[0]] * 150
    rows = [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)]
    rows += [(700, None), (701, [float("nan")] * 8), (702, [None] * 8), (703, [float("inf")] * 8), (None, rows[1][1]),
             (705, [1.0, 2.0]), (10, rows[3][1]), (20, rows[20][1])]
    assert search_rows(spark, rows, 10, k=7, **options) == sorted(brute_topk(rows, 10, 7))


def test_topk_small_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert search_rows(spark, rows, 2) == sorted(brute_topk(rows, 2, 20))
    assert search_rows(spark, [(0, [1.0])], 1) == []
    assert search_rows(spark, [(None, None)], 1) == []


def test_cover_tree_covers():
    points = np.random.default_rng(0).normal(size=(700, 5))
    tree = topk_search.CoverTree(points, leaf=16)
    assert sorted(tree.order.tolist()) == list(range(700))
    for node, (low, high) in enumerate(tree.span):
        gap = np.sqrt(((points[tree.order[low:high]] - points[tree.centre[node]]) ** 2).sum(1))
        assert gap.max() <= tree.radius[node] + 1e-9
        if tree.children[node]:
            assert sum(tree.span[c][1] - tree.span[c][0] for c in tree.children[node]) == high - low
