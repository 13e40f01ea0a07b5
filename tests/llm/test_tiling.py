"""Greedy string tiling against a plain version, and contamination of whole documents."""

import random
import re
import time

import numpy as np

from emberlake.llm import tiling
from emberlake.llm.common import materialize


def plain_tiles(item, text, match):
    """Longest free common run first, earliest in the item, then in the text; until none is long enough."""
    a_free, b_free, out = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and a_free[i + n] and b_free[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < match:
            return out
        out.append((i, j, n))
        a_free[i : i + n], b_free[j : j + n] = [False] * n, [False] * n


def test_tiles_equal_the_plain_version():
    rng = random.Random(2)
    for _ in range(150):
        letters = rng.choice([3, 8, 40])
        item = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        text = [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
        if item and rng.random() < 0.7:  # passages in another order
            cut = rng.randrange(len(item))
            text = text[:20] + item[cut:] + text[20:30] + item[:cut] + text[30:]
        got = tiling.greedy_tiles(np.array(item, np.uint64), np.array(text, np.uint64), 3)
        want = plain_tiles(item, text, 3)
        assert all(item[a : a + n] == text[b : b + n] for a, b, n in got)
        assert len({a + k for a, _, n in got for k in range(n)}) == sum(n for _, _, n in got)
        assert len({b + k for _, b, n in got for k in range(n)}) == sum(n for _, _, n in got)
        if letters == 40:  # with few letters, ties and search lengths allow other tilings
            assert sum(n for _, _, n in got) == sum(n for _, _, n in want)


def test_contamination_against_plain_coverage(spark, documents):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 30)))) for i in range(12)] + [(12, None), (13, "")]
    rows = []
    for doc in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        words = items[rng.randrange(12)][1].split()
        kind = doc % 4
        if kind == 1:
            parts.append(" ".join(words))
        elif kind == 2:  # reordered halves, other case and signs
            half = len(words) // 2
            parts = [" ".join(words[half:]).upper() + "!", *parts, ", ".join(words[:half])]
        elif kind == 3:  # too little of it
            parts.append(" ".join(words[: max(0, len(words) // 3)]))
        rows.append((doc, " ".join(parts)))
    rows += [(60, rows[1][1]), (61, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in tiling.contamination(documents(rows), benchmark).collect()}
    tokens = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    for doc, text in rows:
        found = {}
        for item, passage in items:
            own = tokens(passage)
            share = sum(n for _, _, n in plain_tiles(own, tokens(text), min(5, len(own)))) / len(own) if own else 0
            if share >= 0.5:
                found[item] = share
        r = got[doc]
        assert r["contaminated"] == bool(found) and r["n_items"] == len(found)
        if found:
            best = min(found, key=lambda i: (-found[i], i))
            assert r["item_id"] == best and abs(r["coverage"] - found[best]) < 1e-12
            assert abs(sum(t["length"] for t in r["tiles"]) / len(tokens(dict(items)[best])) - found[best]) < 1e-12
    assert sum(r["contaminated"] for r in got.values()) > 15


def test_empty_benchmark(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["contaminated"] for r in tiling.contamination(documents([(1, "a b c d e f")]), none).collect()] == [False]


def test_runs_by_row_are_the_same_runs():
    rng = random.Random(6)
    for _ in range(200):
        letters = rng.choice([1, 2, 5])
        item = np.array([rng.randrange(letters) for _ in range(rng.randint(0, 25))], np.uint64)
        text = np.array([rng.randrange(letters) for _ in range(rng.randint(0, 40))], np.uint64)
        free_item, free_text = (np.array([rng.random() < 0.8 for _ in x], bool) for x in (item, text))
        for length in (1, 2, 4):
            plain = tiling._runs(item, text, free_item, free_text, length)
            assert sorted(plain) == sorted(tiling._runs_by_row(item, text, free_item, free_text, length))


def test_repetitive_texts_take_no_time():
    start = time.monotonic()
    tiles = tiling.greedy_tiles(np.ones(400, np.uint64), np.ones(30_000, np.uint64), 5)
    assert sum(n for _, _, n in tiles) == 400 and time.monotonic() - start < 10


def test_short_items_and_unspaced_scripts(spark, documents):
    items = [(1, "zebra"), (2, "red kite"), (3, "one two three four"), (4, "\u6771\u4eac\u306f\u65e5\u672c\u306e\u9996\u90fd\u3067\u3059\u3002"), (5, "?!"),
             (6, "\u4eba\u5de5\u667a\u80fd\uff0c\u673a\u5668\u5b66\u4e60\u3002"), (7, "\u0e01\u0e32\u0e23\u0e40\u0e23\u0e35\u0e22\u0e19")]
    texts = [
        ("a Zebra!", {1}), ("zebras", set()), ("the red, kite", {2}), ("red x kite", set()),
        ("x one two three four y", {3}), ("one two x three four", set()),
        ("\u6614\u3001\u6771\u4eac\u306f\u65e5\u672c\u306e\u9996\u90fd\u3067\u3059\u3088", {4}), ("\u6771\u4eac \u4eba\u5de5", set()),
        ("\u6211\u4eec\u7684\u4eba\u5de5\u667a\u80fd\u673a\u5668\u5b66\u4e60\u8bfe", {6}), ("\u0e01\u0e32\u0e23\u0e40\u0e23\u0e35\u0e22\u0e19\u0e20\u0e32\u0e29\u0e32", {7}),
        ("one", set()), ("", set()), (None, set()),
    ]
    found = tiling.tile_pairs(documents([(i, t) for i, (t, _) in enumerate(texts)]), spark.createDataFrame(items, "item_id long, text string"))
    got = {}
    for r in found.collect():
        got.setdefault(r["id"], set()).add(r["item"])
    assert got == {i: want for i, (_, want) in enumerate(texts) if want}


def test_a_shared_phrase_makes_no_pairs(spark, documents):
    """In a third of all documents and in every item: pairs come of the rare tokens alone."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    phrase = " ".join(word() for _ in range(18))
    items = [(i, f"{' '.join(word() for _ in range(15))} {phrase} {' '.join(word() for _ in range(10))}") for i in range(40)]
    rows = [(i, " ".join([*(word() for _ in range(30)), phrase if i % 3 == 0 else "", items[i % 40][1] if i % 50 == 0 else ""])) for i in range(600)]
    docs, benchmark = documents(rows), spark.createDataFrame(items, "item_id long, text string")
    item_seeds = materialize(tiling.seeds(benchmark, "item_id", "text", 5))
    hits = materialize(tiling.seeds(docs, "doc_id", "text", 5, tiling.seed_map(item_seeds), [5]))
    assert hits.join(item_seeds.select("seed"), "seed").count() > 100_000
    pairs = {(r["id"], r["item"]) for r in tiling.candidate_pairs(hits, item_seeds).collect()}
    assert pairs == {(i, i % 40) for i in range(0, 600, 50)}
    got = {r["doc_id"]: r["item_id"] for r in tiling.contamination(docs, benchmark).collect() if r["contaminated"]}
    assert got == dict(pairs)


def test_set_aside_never_loses_a_pair():
    """Any choice of windows that avoids the remaining seeds covers less than the threshold."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        length, size = int(rng.integers(5, 40)), int(rng.integers(1, 6))
        windows = length - size + 1
        if windows < 1:
            continue
        seeds, costs = rng.integers(0, rng.integers(1, windows + 2), windows), rng.integers(1, 50, windows)
        costs = np.array([costs[seeds == s][0] for s in seeds], float)
        aside = tiling.set_aside(costs, seeds, np.arange(windows), size, 0.5 * length)
        reach = {p + k for p in np.flatnonzero(aside) for k in range(size)}
        assert len(reach) < 0.5 * length
        assert all(aside[seeds == s].all() or not aside[seeds == s].any() for s in seeds)


def test_ties_name_the_least_item(spark, documents):
    items = spark.createDataFrame([(7, "one two three four five six"), (3, "one two three four five six"), (5, "seven eight nine ten eleven")], "item_id long, text string")
    rows = tiling.contamination(documents([(1, "x one two three four five six seven eight nine ten eleven")]), items).collect()
    assert rows[0]["item_id"] == 3 and rows[0]["n_items"] == 3
