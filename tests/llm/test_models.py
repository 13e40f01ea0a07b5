"""Language identification, quality, language model: brute force and held-out accuracy."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from emberlake.llm import langid, ppm, quality
from emberlake.llm.common import read_table

from .conftest import PROSE

SF = "/root/testdata/sf0.01"


def test_language_accuracy_from_text_alone(spark):
    """Trained on one half, the other half is told without its declaration and host."""
    docs = read_table(spark, SF, "documents")
    train = docs.filter("doc_id % 2 = 0")
    rest = docs.filter("doc_id % 2 = 1").withColumn("truth", F.col("lang")).withColumn("lang", F.lit(None).cast("string"))
    got = langid.identify(rest, host_col=None, train_on=train).join(rest.select("doc_id", "truth"), "doc_id").collect()
    assert np.mean([r["language"] == r["truth"] for r in got]) > 0.98 and np.mean([r["accepted"] for r in got]) > 0.98


def test_evidence_decides_where_text_does_not(spark, documents):
    rows = [(i, PROSE["en"], "en", "www.en-site.com") for i in range(40)] + [(50 + i, PROSE["de"], "de", "www.seite.de") for i in range(40)]
    rows += [(100, "12 xx", None, "www.seite.de"), (101, "12 xx", None, "www.en-site.com"), (102, "12 xx", "de", None), (103, "日本語 日本語 日本語 日本語 日本語", None, "www.en-site.com")]
    got = {r["doc_id"]: r for r in langid.identify(documents(rows)).collect()}
    assert got[100]["language"] == "de" and got[101]["language"] == "en" and got[102]["language"] == "de"
    assert got[103]["language"] == "und" and not got[103]["accepted"]
    by_address = documents(rows).withColumn("url", F.concat(F.lit("http://"), "source", F.lit("/x")))
    again = {r["doc_id"]: r for r in langid.identify(by_address, host_col=None, address_col="url").collect()}
    assert again[100]["language"] == "de" and again[101]["language"] == "en"


def test_posterior_equals_bayes(spark, documents):
    """The fused posterior of a short text, recomputed from the evidence by hand."""
    rows = [(i, PROSE["en"], "en", "a") for i in range(30)] + [(50 + i, PROSE["de"], "de", "b") for i in range(10)] + [(99, "de wo", "en", "b")]
    docs = documents(rows)
    names = langid.languages_of(docs, "lang")
    logs = langid.train(docs, "text", "lang", names)
    (_, bins), = langid._trigrams(pa.array(["de wo"], pa.large_string()))
    text = [langid.TEMPER * logs[i][bins].sum(dtype=float) for i in range(2)] + [-langid.TEMPER * len(bins) * math.log(1 << langid.BINS_BITS)]
    own = np.exp(np.array(text[:2]) - max(text[:2]))
    own /= own.sum()
    # Expected rows by language (de, en) of all, of host b, of declaration en.
    whole, host, declared = np.array([10.0, 30.0]) + own, np.array([10.0, 0.0]) + own, np.array([0.0, 30.0]) + own
    shares = (whole + 1) / (whole.sum() + 2)
    k = langid.SMOOTHING
    site = (host + k * shares) / (host.sum() + k)
    prior = (host + k * site) / (host.sum() + k)
    share = (declared.sum() + 1) / (whole.sum() + 1)
    said = (declared + k * share) / (whole + k)
    score = np.exp([*(np.array(text[:2]) + np.log(prior) + np.log(said)), text[2] + math.log(langid.UNKNOWN_PRIOR)])
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}[99]
    best = int(np.argmax(score))
    assert got["language"] == [*names, "und"][best]
    assert abs(got["posterior"] - score[best] / score.sum()) < 1e-3


def test_quality_held_out(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    scored = quality.score(docs, quality.train(docs, labels, where=~held)).join(labels.filter(held), "doc_id").collect()
    good = [r["score"] for r in scored if r["quality"] == 1]
    bad = [r["score"] for r in scored if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= 0.7 for s in good]) > 0.95 and np.mean([s < 0.7 for s in bad]) > 0.8


def test_ftrl_equals_its_recurrence():
    """Against a plain per-coordinate loop."""
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(16, 4, replace=False)), rng.random(4)) for _ in range(30)]
    labels = rng.integers(0, 2, 30)
    got = quality.ftrl(rows, labels, bits=4, epochs=2, l1=0.05)
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        if abs(z[i]) <= 0.05:
            return 0.0
        return -(z[i] - math.copysign(0.05, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for epoch in range(2):
        for r in np.random.default_rng(epoch).permutation(30):
            x = dict(zip(rows[r][0].tolist(), rows[r][1].tolist())) | {16: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - labels[r]) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    assert np.allclose(got, [weight(i) for i in range(17)])


def test_features_do_not_depend_on_neighbours():
    texts = ["The THE the!!", "", "one one one two 12 12", None, "Ünïcode wörds   here"]
    alone = [next(quality.features(pa.array([t], pa.large_string()))) for t in texts]
    for (i, index, value), (_, a, b) in zip(quality.features(pa.array(texts, pa.large_string())), alone):
        assert (index == a).all() and (value == b).all()


def test_ppm_against_brute_force(documents):
    rng = random.Random(6)
    words = ["a", "an", "and", "band", "bandana", "Ωé", "x" * 40, "banana"]
    rows = [(i, " \t".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(40)] + [(40, None), (41, "zzz qqq\x00\x01"), (42, "AND\n and ")]
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1]
    tokens = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").replace("AND", "and")) if w] for i, t in rows}
    text = {i: " ".join(w).encode() + b"\n" for i, w in tokens.items()}
    counts = collections.Counter()
    follow = collections.defaultdict(collections.Counter)
    for i, _ in learnt:
        counts.update(tokens[i])
        counts[None] += 1
        padded = b"\n" * 5 + text[i]
        for j in range(5, len(padded)):
            for k in range(6):
                follow[padded[j - k : j]][padded[j]] += 1

    def coded(body):
        padded, total = b"\n" * 5 + body, 0.0
        for j in range(5, len(padded)):
            excluded, found = set(), False
            for k in range(5, -1, -1):
                seen = {s: n for s, n in follow.get(padded[j - k : j], {}).items() if s not in excluded}
                if not seen:
                    continue
                n, d = sum(seen.values()), len(seen)
                if padded[j] in seen:
                    total, found = total + math.log10(seen[padded[j]] / (n + d)), True
                    break
                total += math.log10(d / (n + d))
                excluded |= set(seen)
            if not found:
                total -= math.log10(257 - len(excluded))
        return total

    n, v = sum(counts.values()), len(counts)
    for most in (ppm.MAX_GRAMS, 150):  # one block and several
        got = {r["doc_id"]: r for r in ppm.score(documents(rows), documents(learnt), max_grams=most).collect()}
        for i, own in tokens.items():
            r = got[i]
            base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*own, None])
            assert (r["n_tokens"], r["train_tokens"]) == (len(own) + 1, n)
            assert r["n_known"] == sum(w in counts for w in [*own, None])
            assert abs(r["base_score"] - base) < 1e-9 * abs(base) and abs(r["score"] - coded(text[i])) < 1e-5 * abs(coded(text[i]))


def test_ppm_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    body = np.concatenate([[10] * 3, rng.choice([97, 98, 99], 200), [10]]).astype(np.uint64)
    codes = sum(body[j : len(body) - 3 + j] << np.uint64(8 * (3 - j)) for j in range(4))
    key, n = np.unique(codes, return_counts=True)
    pair, pair_n = np.unique(codes & np.uint64(0xFFFF), return_counts=True)
    trie = ppm.Trie(key, n, pair, pair_n, 3)
    for context in (0x616263, 0x0A0A0A, 0x7A7A7A, 0x7A7A61, 0x0A610A):
        symbols = np.arange(256, dtype=np.uint64) | np.uint64(context << 8)
        total = (10 ** trie.log10(symbols)).sum()
        assert 0.995 < total < 1 + 1e-6  # one symbol of 257 is no byte
