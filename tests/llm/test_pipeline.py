"""The pipeline's stages one after another, against what each should do to planted documents."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from emberlake.llm import langid, minhash, packing, secrets, tiling
from emberlake.llm.common import read_table

from .conftest import PROSE, hard_rows
from .test_minhash import brute

SF = "/root/testdata/sf0.001"


def planted():
    rng = random.Random(1)
    vocabulary = {k: v.split() for k, v in PROSE.items()}

    def prose(n, lang="en"):
        return " ".join(rng.choice(vocabulary[lang]) + rng.choice(["", "s", "ly"]) for _ in range(n))

    rows = [(i, prose(80), "en", f"src{i % 3}") for i in range(40)] + [(40 + i, prose(80, "de"), "de", "src1") for i in range(20)]
    near = rows[3][1].split()
    near[40] = "changed"
    item = " ".join(f"bench{i} mark{i}" for i in range(20))
    halves = item.split()
    rows += [
        (70, rows[3][1], "en", "src0"), (71, " ".join(near), "en", "src0"), (72, "日本語 " * 30, None, "src0"), (73, None, "en", "src0"),
        (74, f"{prose(40)} {item} {prose(40)}", "en", "src0"), (75, " ".join(halves[20:]) + " " + prose(30) + " " + " ".join(halves[:20]), "en", "src0"),
        (76, f"{prose(50)} password=9f8b7c6d5e4f3a2b1c0d {prose(30)}", "en", "src0"), (77, f"{prose(50)} call 4785380592391139 now", "en", "src0"),
    ]
    return rows, item


def test_stages(spark, documents, tmp_path):
    rows, item = planted()
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(rows + [rows[0]]).withColumn("id", F.lit("x"))
    texts = {r[0]: r[1] for r in rows}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = [r["doc_id"] for r in docs.collect()]
    assert set(texts) - set(kept["language"]) == {72, 73}
    label, _ = brute([r[:2] for r in rows if r[0] not in (72, 73)], 5, 80)
    assert sorted(kept["near_duplicates"]) == sorted(i for i in label if label[i] == i)
    assert {70, 71} & set(kept["near_duplicates"]) == set()
    assert set(kept["near_duplicates"]) - set(kept["decontaminate"]) == {74, 75}
    assert sorted(kept["secrets"]) == sorted(kept["decontaminate"])
    clean = {r["doc_id"]: r for r in spark.read.parquet(f"{tmp_path}/secrets").collect()}
    assert "9f8b7c6d5e4f3a2b1c0d" not in clean[76]["text"] and clean[76]["n_chars"] == len(clean[76]["text"])
    assert all(clean[i]["text"] == texts[i] for i in clean if i != 76)
    assert set(kept["packing"]) == set(kept["secrets"])


def test_run_equals_its_stages(spark):
    docs = read_table(spark, SF, "documents")
    spoken = {r["doc_id"] for r in langid.identify(docs).collect() if r["accepted"]}
    docs = docs.filter(F.col("doc_id").isin(list(spoken)))
    alone = {r["doc_id"] for r in minhash.near_duplicates(docs).collect() if r["kept"]}
    docs = docs.filter(F.col("doc_id").isin(list(alone)))
    bad = {r["doc_id"] for r in tiling.contamination(docs, read_table(spark, SF, "benchmark")).collect() if r["contaminated"]}
    docs = docs.filter(~F.col("doc_id").isin(list(bad)))
    docs = secrets.redact(docs, secrets.scan(docs))
    want = {tuple(r) for r in packing.tokenize_pieces(docs, with_ids=False).collect()}
    got = corpus_pipeline.run(spark, SF)
    assert {tuple(r) for r in got.select("doc_id", "piece", "start", "length", "ids_crc32").collect()} == want


def test_hard_rows_and_empty_tables(spark, documents, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (hard_rows(), []):
        docs = documents(rows, clash=True)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{len(rows)}-{i}")
            docs = spark.read.parquet(f"{tmp_path}/{len(rows)}-{i}")
            assert rows or docs.count() == 0
        assert not rows or {r["doc_id"] for r in docs.collect()} <= {r[0] for r in rows}
