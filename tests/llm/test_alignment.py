"""Alignment against byte by byte comparison; sparse products against dense ones; long texts; hard rows."""

import hashlib
import random

import numpy as np
import pytest

from emberlake.llm import alignment
from emberlake.llm.common import materialize
from emberlake.llm.queries import op12_alignment

from .conftest import PROSE, hard_rows


@pytest.fixture(scope="module")
def own():
    return alignment.Pair(*alignment.tokenizer_files())


def random_csr(rng, rows, columns, density=0.3):
    dense = rng.integers(1, 5, (rows, columns)) * (rng.random((rows, columns)) < density)
    indices = [np.flatnonzero(r) for r in dense]
    indptr = np.cumsum([0, *map(len, indices)])
    flat = np.concatenate(indices) if rows else np.empty(0, np.int64)
    return alignment.Csr(indptr, flat, dense[np.repeat(np.arange(rows), np.diff(indptr)), flat], columns), dense


def test_gustavson_is_the_matrix_product():
    rng = np.random.default_rng(2)
    for rows, middle, columns in [(1, 1, 1), (5, 7, 3), (0, 4, 2), (6, 1, 9), (20, 30, 25), (3, 3, 0)]:
        (a, dense_a), (b, dense_b) = random_csr(rng, rows, middle), random_csr(rng, middle, columns)
        made = alignment.gustavson(a, b)
        assert np.array_equal(made.dense(), dense_a @ dense_b)
        assert np.array_equal(a.transpose().dense(), dense_a.T)
        assert alignment.products_by_row(a, b).sum() == sum((dense_b[k] != 0).sum() for i, k in zip(*np.nonzero(dense_a)))


def brute(own, text):
    """Tokens by bytes, one by one: links as position pairs, groups as text."""
    none = {"a": [], "b": [], "links": {}, "groups": "", "shared": set()}
    if not text:
        return none
    raw = (" " + text).encode()
    a = own.a.encode(" " + text, add_special_tokens=False).ids
    b = own.b.encode(text)
    if b"".join(own.a_bytes[i] for i in a) != raw or b"".join(own.b_bytes[i] for i in b) != raw:
        return none
    owner_a = [k for k, i in enumerate(a) for _ in own.a_bytes[i]]
    owner_b = [k for k, i in enumerate(b) for _ in own.b_bytes[i]]
    links = {}
    for pair in zip(owner_a, owner_b, strict=True):
        links[pair] = links.get(pair, 0) + 1
    ends = {i + 1 for i in range(len(raw)) if (i + 1 == len(raw)) or (owner_a[i] != owner_a[i + 1] and owner_b[i] != owner_b[i + 1])}
    groups, start, shared = [], 0, set()
    for end in sorted(ends):
        own_a, own_b = sorted(set(owner_a[start:end])), sorted(set(owner_b[start:end]))
        groups.append(",".join(str(a[k]) for k in own_a) + "|" + ",".join(str(b[k]) for k in own_b))
        shared |= {(x, y) for x in own_a for y in own_b}
        start = end
    return {"a": a, "b": b, "links": links, "groups": ";".join(groups), "shared": shared, "n_groups": len(groups)}


TEXTS = [
    PROSE["en"], PROSE["fr"] + PROSE["de"], "don't <s> <unk> <0x41> <|endoftext|>", "  two  spaces \n\n\n\tand  ",
    "日本語のテキスト 한국어 😀 é", "▁marked", "x", " ", " 　 z", "12345 67", "internationalisation " * 4, "\x00a",
]


def test_against_brute_force(spark, documents, own):
    docs = documents([*enumerate(TEXTS), (50, None), (51, "")], clash=True)
    texts = dict(enumerate(TEXTS)) | {50: None, 51: ""}
    plain = {i: brute(own, t) for i, t in texts.items()}
    aligned = materialize(alignment.align(docs))
    for r in aligned.collect():
        p = plain[r["doc_id"]]
        assert (r["n_a"], r["n_b"], r["n_links"], r["n_shared"]) == (len(p["a"]), len(p["b"]), len(p["links"]), len(p["shared"])), r
        assert r["groups"] == p["groups"] and r["n_groups"] == (len(p["groups"].split(";")) if p["groups"] else 0)
        pairs = {}
        for i, j in p["links"]:
            pairs[p["a"][i], p["b"][j]] = pairs.get((p["a"][i], p["b"][j]), 0) + 1
        assert {(x["a"], x["b"]): x["links"] for x in r["pairs"]} == pairs
    assert plain[5]["a"] == [] and plain[0]["a"]  # U+2581 in a text is no space
    for kind, key in (("overlap", "links"), ("group", "shared")):
        found = {}
        for r in alignment.links(docs, kind).collect():
            assert plain[r["doc_id"]]["a"][r["a_at"]] == r["a"] and plain[r["doc_id"]]["b"][r["b_at"]] == r["b"]
            found.setdefault(r["doc_id"], {})[r["a_at"], r["b_at"]] = r["weight"]
        for i, p in plain.items():
            assert found.get(i, {}) == (p[key] if key == "links" else dict.fromkeys(p[key], 1))


@pytest.mark.parametrize("hot", [1, 40, alignment.HOT_PAIRS])
def test_rating_by_corpus_counts(spark, documents, own, hot):
    texts = {i: t for i, t in enumerate([*TEXTS, PROSE["en"], PROSE["en"][:60], "the the the river", None])}
    plain = {i: brute(own, t) for i, t in texts.items()}
    counts = {}
    for p in plain.values():
        for pair in {(p["a"][i], p["b"][j]) for i, j in p["links"]}:
            counts[pair] = counts.get(pair, 0) + 1
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    aligned = materialize(alignment.align(documents(list(texts.items()))))
    rated = {r["doc_id"]: r for r in alignment.rate(aligned, "doc_id", hot).collect()}
    for i, p in plain.items():
        ids = [(p["a"][x], p["b"][y]) for x, y in p["links"]]
        if ids:
            assert rated[i]["count_sum"] == sum(counts[x] for x in ids)
            assert rated[i]["n_best"] == sum(counts[x] == top[x[0]] for x in ids)
        else:
            assert i not in rated


def test_long_texts_are_added_up(own, monkeypatch):
    text = " " + (PROSE["en"] + "\n\n" + PROSE["de"] + "日本 x  y " + "a" * 400) * 3
    whole, spelt = alignment.align_texts(own, [text])
    assert spelt == [True]
    monkeypatch.setattr(alignment, "chunks_of", lambda t, plain=alignment.chunks_of: plain(t, 90))
    assert len(list(alignment.chunks_of(text))) > 5
    one, many = alignment.describe(own, whole), alignment.describe_long(own, text)
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_shared", "groups"):
        assert list(getattr(one, name)) == list(getattr(many, name))
    for x, y in zip(one.pairs[0], many.pairs[0], strict=True):
        assert np.array_equal(x, y)
    unspelt = alignment.describe_long(own, text + " ▁ x")
    assert unspelt.groups == [""] and unspelt.n_a.tolist() == [0] and len(unspelt.pairs[0][0]) == 0


def test_both_libraries_encode_alike(own):
    """The faster library's ids are those of the two tokenizers' own libraries: over texts, every word of both
    vocabularies, and random strings of plain signs."""
    assert own.fast is not None and own.fast_b is not None
    rng = random.Random(8)
    plain = [c for c in map(chr, range(0x530)) if not alignment._ODD.match(c)]
    texts = [t for t in TEXTS if t] + ["".join(rng.choices(plain, k=40)) for _ in range(300)]
    texts += ["".join(rng.choices("aeinrst  \n\u00e9\u00fc.,1", k=200)) for _ in range(300)]
    for tokens in (own.a_bytes, own.b_bytes):
        texts += [x for x in (t.decode(errors="ignore") for t in tokens) if x and not alignment._ODD.search(x)]
    assert [list(own.encode_a(" " + t)) for t in texts] == [x.ids for x in own.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert [list(own.encode_b(" " + t)) for t in texts] == own.b.encode(texts)


def test_query_and_hard_rows(spark, documents, tmp_path):
    documents(hard_rows(), clash=True).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op12_alignment(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in hard_rows())
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] in (1, 3, 4, 9)}
    for i in (3, 4):
        assert tuple(by_id[i])[1:] == (0, 0, 0, 0, 0, 0, 0, "")
    own_pair = alignment.Pair(*alignment.tokenizer_files())
    assert by_id[9]["groups_sha256"] == hashlib.sha256(brute(own_pair, "one")["groups"].encode()).hexdigest()
    twice = [tuple(r) for r in rows if r["doc_id"] == 2]
    assert len(twice) == 2 and twice[0] == twice[1]
    empty = str(tmp_path / "none")
    documents([]).write.parquet(f"{empty}/documents.parquet")
    assert op12_alignment(spark, empty).collect() == []
