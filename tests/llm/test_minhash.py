"""Near duplicates against brute force; the sketch's properties."""

import random
import re

import numpy as np

from emberlake.llm import minhash
from emberlake.llm.common import mix64


def brute(rows, shingle, percent):
    sets = {}
    for i, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        n = min(shingle, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i, x in sets.items():
            for j, y in sets.items():
                both = len(x & y)
                if x and y and 100 * both >= percent * (len(x) + len(y) - both) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label, {i: len(s) for i, s in sets.items()}


def corpus():
    random.seed(5)
    words = [f"w{i}" for i in range(300)]
    rows, doc = [], 0
    for family in range(12):
        base = [random.choice(words) for _ in range(random.randint(30, 120))]
        for copy in range(random.choice([1, 2, 5, 25])):
            text = list(base)
            for _ in range(random.randint(0, max(1, len(base) // 14))):
                text[random.randrange(len(text))] = random.choice(words)
            rows.append((doc, " ".join(text)))
            doc += 1
    return rows + [(doc, ""), (doc + 1, None), (doc + 2, "one"), (doc + 3, "one"), (doc + 4, rows[0][1])]


def test_against_brute_force(documents):
    rows = corpus()
    for shingle, percent in ((2, 80), (5, 60)):
        label, sizes = brute(rows, shingle, percent)
        got = {r["doc_id"]: r for r in minhash.near_duplicates(documents(rows), shingle=shingle, percent=percent).collect()}
        assert {i: r["component_id"] for i, r in got.items()} == label
        assert {i: r["n_shingles"] for i, r in got.items()} == sizes
        assert all(r["kept"] == (label[i] == i) for i, r in got.items())


def test_small_blocks_lose_no_link(documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)
    rows = corpus()
    label, _ = brute(rows, 2, 80)
    got = minhash.near_duplicates(documents(rows), shingle=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == label


def test_blocks_bring_every_two_components_together(spark, monkeypatch):
    """Each pair of members of different components meets; a large component's own blocks do not."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 8)
    rng = random.Random(4)
    sizes = {"x": [60, 1, 1, 2], "y": [1] * 30, "z": [20, 20, 5, 3, 1], "w": [9]}
    rows, rep = [], 0
    for key, parts in sizes.items():
        for label, n in enumerate(parts):
            for _ in range(n):
                rows.append((key, rep, 1000 + label, rng.randrange(10, 99)))
                rep += 1
    found = minhash._blocks(spark.createDataFrame(rows, "key string, rep long, label long, bytes long")).collect()
    units, made = {}, {}
    for r in found:
        unit = (r["key"], min(r["block"], r["other"]), max(r["block"], r["other"]))
        units.setdefault(unit, {})[r["rep"]] = r["block"]
        made[r["key"]] = made.get(r["key"], 0) + 1
    label = {r[1]: (r[0], r[2]) for r in rows}
    met = set()
    for (_, low, high), members in units.items():
        met |= {(x, y) for x in members for y in members if x < y and (low == high or members[x] != members[y])}
        assert len(members) <= 40
    need = {(x, y) for x in label for y in label if x < y and label[x][0] == label[y][0] and label[x] != label[y]}
    assert need <= met
    assert made["x"] < 3 * 64 and "w" not in made  # in proportion, though pairs of blocks are many


def test_a_large_group_of_copies_and_near_copies(documents):
    """A third of all rows are exact copies, and near copies of them are not all linked with the least."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(60)]
    rows = [(i, " ".join(base)) for i in range(200)]
    for i in range(200, 330):
        text = list(base)
        for _ in range(rng.randrange(1, 9)):
            text[rng.randrange(60)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(330, 400)]
    label, sizes = brute(rows, 2, 80)
    got = minhash.near_duplicates(documents(rows), shingle=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == label
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes


def test_joining_links():
    random = np.random.default_rng(8)
    base = random.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = []
    for _ in range(40):
        keep = base[random.random(60) < random.choice([0.8, 0.95])]
        sets.append(np.unique(np.r_[keep, random.integers(0, 1 << 62, random.integers(0, 9)).astype(np.uint64)]))
    found = minhash.joining_links(sets, list(range(40)), np.zeros(40, int), 80)
    edges = [
        (i, j) for i in range(40) for j in range(i)
        if 100 * (both := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - both)
    ]

    def groups(pairs):
        label = list(range(40))
        for _ in range(40):
            for i, j in pairs:
                label[i] = label[j] = min(label[i], label[j])
        return label

    assert groups(found) == groups(edges) and set(found) <= set(edges) and len(set(groups(edges))) > 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 103)}
    assert {r["id"]: r["component"] for r in got} == want and len(got) == len(want)


def test_sketch_fills_and_estimates():
    random = np.random.default_rng(3)
    for n in (1, 2, 7, 100, 5000):
        x = mix64(random.integers(0, 1 << 62, n).astype(np.uint64))
        assert (minhash.sketch(x, 128) != minhash._EMPTY).all()
    errors = []
    for _ in range(30):
        both, left, right = (random.integers(0, 1 << 62, n).astype(np.uint64) for n in (80, 10, 10))
        x, y = np.r_[both, left], np.r_[both, right]
        errors.append((minhash.sketch(x, 128) == minhash.sketch(y, 128)).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.2
