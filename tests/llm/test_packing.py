"""Packing: ids equal to whole-text encoding, constraints, and closeness to the bound."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlake.llm import packing
from emberlake.llm.common import materialize


def test_ids_are_those_of_the_whole_text():
    encoder = packing.Encoder(packing.tokenizer_text())
    texts = [
        "", "The the THE 's don't", "a\x1cb\x85c d é İ Σσ 가", "x<|endoftext|>y <|startoftext|>",
        "café niño 123 4,5;6 Жж 日本語", "A" * 5000, "\t\n\x0b\x0c\r", "ſ K K",
    ]
    assert list(encoder.encode(texts)) == [encoder.whole(t) for t in texts]
    assert list(encoder.encode(texts)) == [encoder.whole(t) for t in texts]  # from memory


def test_pieces_and_sequences(spark, documents):
    encoder = packing.Encoder(packing.tokenizer_text())
    rows = [(i, f"word{i} and more " * (1 + i * i % 37)) for i in range(60)] + [(100, "long text of many words " * 900), (101, None)]
    pieces = materialize(packing.tokenize_pieces(documents(rows), sequence=256))
    packed = packing.pack(pieces, sequence=256).collect()
    ids = {i: list(np.frombuffer(encoder.whole(t or ""), "<u4")) + [1] for i, t in rows}
    for r in packed:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids"] == own and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and r["start"] == 256 * r["piece"]
    assert sum(r["length"] for r in packed) == sum(map(len, ids.values()))
    used = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    bins = []  # first fit by falling length
    for length in sorted((r["length"] for r in packed), reverse=True):
        at = next((i for i, n in enumerate(bins) if n + length <= 256), None)
        if at is None:
            bins.append(length)
        else:
            bins[at] += length
    assert max(used.values()) <= 256 and len(used) <= len(bins)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packing.pack(pieces, sequence=256)).collect()}
    assert {k: len(v) for k, v in whole.items()} == used


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_all_constraints_hold(spark, score):
    lengths = [int(x) for x in np.random.default_rng(1).integers(1, 100, 500)]
    pieces = spark.createDataFrame([(x,) for x in lengths], "length long")
    packed = packing.pack(pieces, sequence=100, documents=5, attention=6000 + 100 * 100 // 2, score=score, group_pieces=200)
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("d"), F.sum(F.col("length") ** 2).alias("a")).collect()
    assert sum(r["d"] for r in sums) == 500
    assert all(r["n"] <= 100 and r["d"] <= 5 and r["a"] <= 11000 for r in sums)


def test_best_fit_takes_the_fullest_bin():
    bins, _ = packing.best_fit(np.array([[60.0], [50.0], [40.0], [50.0]]), np.array([100.0]), np.array([1.0]))
    assert bins[0] == bins[2] and bins[1] == bins[3] != bins[0]
    with pytest.raises(ValueError):
        packing.best_fit(np.array([[101.0]]), np.array([100.0]), np.array([1.0]))
