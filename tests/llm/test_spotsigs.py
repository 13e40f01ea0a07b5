"""Fingerprints against a plain version, neighbours over ranges, and all similar pairs."""

import hashlib
import random
import re

import numpy as np

from emberlake.llm import spotsigs

from .conftest import PROSE


def plain_signatures(text, chain=spotsigs.CHAIN):
    words = re.findall("[a-z0-9]+", text.lower())
    anchors = set(spotsigs.ANCHORS)
    if not any(w in anchors for w in words) or all(w in anchors for w in words):
        return [tuple(words[i : i + 1] + words[i + 1 : i + 1 + chain]) for i in range(len(words))]
    out = []
    for i, w in enumerate(words):
        if w in anchors:
            out.append((w, *[x for x in words[i + 1 :] if x not in anchors][:chain]))
    return out


def plain_likeness(x, y):
    from collections import Counter

    a, b = Counter(plain_signatures(x)), Counter(plain_signatures(y))
    if not x and not y:
        return 1.0
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def texts():
    rng = random.Random(3)
    words = PROSE["en"].split() + [f"w{i}" for i in range(40)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(70)]
    out[5], out[6], out[7], out[8], out[9] = out[4], "", "the of and", "w1 w2 w3 w4", out[4]
    return out


def test_ids_of_text(spark):
    """The same neighbours as for numbers of the same order, over many ranges; a range is a task."""
    rows = [(f"id-{i:05d}", t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    one = {r["doc_id"]: r for r in spotsigs.fingerprint_neighbours(docs).collect()}
    many = spotsigs.fingerprint_neighbours(docs, range_rows=4)
    assert {r["doc_id"]: r for r in many.collect()} == one and len(one) == len(rows)
    held = [len(p) for p in many.select("doc_id").rdd.glom().collect()]
    assert len(held) > 10 and max(held) <= 20 and sum(h > 0 for h in held) == len(held)
    for i, (name, text) in enumerate(rows):
        assert abs(one[name]["near_next"] - plain_likeness(text, rows[i - 1][1])) < 1e-12


def test_neighbours(documents):
    all_texts = texts()
    rows = list(enumerate(all_texts))
    whole = {r["doc_id"]: r for r in spotsigs.fingerprint_neighbours(documents(rows)).collect()}
    for parts in (1, 9):
        got = {r["doc_id"]: r for r in spotsigs.fingerprint_neighbours(documents(rows), range_rows=parts).collect()}
        assert got == whole
    for i, text in rows:
        following = all_texts[i - 1]  # descending ids; after 0 comes the last
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = whole[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(r["near_edited"] - plain_likeness(text, changed)) < 1e-12
        assert abs(r["near_next"] - plain_likeness(text, following)) < 1e-12
    assert whole[4]["fingerprint"] == whole[5]["fingerprint"] == whole[9]["fingerprint"] and whole[5]["near_next"] == 1.0


def test_lone_document(documents):
    (r,) = spotsigs.fingerprint_neighbours(documents([(7, "some of the words")])).collect()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(("some of the words"[:9] + "some of the words"[:8]).encode()).hexdigest()


def test_similar_pairs(documents):
    rng = random.Random(9)
    rows, base = [], [f"{a} w{i} v{i}" for i, a in enumerate(spotsigs.ANCHORS[:60])]
    for i in range(40):
        kept = [s for s in base if rng.random() < rng.choice([0.85, 0.97])]
        rows.append((i, " ".join(kept)))
    rows += [(40, rows[0][1]), (41, ""), (42, None)]
    sets = {i: frozenset(plain_signatures(t)) for i, t in rows if t}
    classes, pairs = spotsigs.similar_pairs(spotsigs.fingerprints(documents(rows)), 0.8)
    classes = {r["id"]: r["class"] for r in classes.collect()}
    assert classes[40] == 0 and set(classes) == set(range(41))
    got = {(r["a"], r["b"]): r["similarity"] for r in pairs.collect()}
    want = {
        (i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j])
        for i in range(40) for j in range(i + 1, 40) if sets[i] != sets[j]
    }
    want = {k: v for k, v in want.items() if v >= 0.8 and classes[k[0]] == k[0] and classes[k[1]] == k[1]}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want) and len(want) > 10


def test_signatures_do_not_depend_on_neighbours():
    signer = spotsigs.Signer(spotsigs.ANCHORS, 2, 1)
    many = texts()
    for text, signed in zip(many, signer(many)):
        assert (np.array(next(signer([text]))) == signed).all()
