"""Byte-level BPE against a plain merger over the pattern's matches, long texts cut, and the round trip."""

import base64
import hashlib

import public_tokenizers
import pytest
import regex

from emberlake.llm import bytebpe

from .conftest import hard_rows

TEXTS = [
    "", " ", "  ", "a", "don't we'll 'S I'm", "x  y   z\n\n  w ", "日本語のテキスト 한국어 ελληνικά Ж", "1234 56,7.8",
    "<|endoftext|> is text", "é é  　x", "\x1c\x85 ​", "😀👨‍👩‍👧", "tab\tand\r\nline", "a" * 300 + " " * 40 + "b",
]


@pytest.fixture(scope="module")
def ranks():
    lines = bytebpe.ranks_text().splitlines()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def plain(ranks, text):
    out = []
    for match in regex.findall(public_tokenizers.PATTERN, text):
        parts = [bytes([b]) for b in match.encode()]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        out += [ranks[p] for p in parts]
    return out


def test_ids_are_those_of_plain_merging(spark, documents, ranks):
    docs = documents(list(enumerate(TEXTS)), clash=True)
    rows = bytebpe.encode(docs)
    ids = {r["doc_id"]: r["ids"] for r in rows.collect()}
    assert ids == {i: plain(ranks, t) for i, t in enumerate(TEXTS)}
    back = {r["doc_id"]: bytes(r["bytes"]) for r in bytebpe.decode(rows).collect()}
    assert back == {i: t.encode() for i, t in enumerate(TEXTS)}
    told = {r["doc_id"]: r for r in bytebpe.digests(rows).collect()}
    for i, t in enumerate(TEXTS):
        assert told[i]["n_tokens"] == len(ids[i])
        assert told[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids[i])).encode()).hexdigest()
        assert told[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("limit", [1, 7, 50])
def test_segments_end_where_matches_end(limit, monkeypatch):
    monkeypatch.setattr(bytebpe, "_RUN", regex.compile(f"[{bytebpe.WHITE}]{{3,}}"))
    text = " ".join(TEXTS) + "   \n\n\n" + "".join(reversed(" ".join(TEXTS)))
    parts = list(bytebpe.segments(text, limit))
    assert "".join(p for p, _ in parts) == text and len(parts) > 10
    found = [m for p, one in parts for m in ([p] if one else regex.findall(public_tokenizers.PATTERN, p))]
    assert found == regex.findall(public_tokenizers.PATTERN, text)


def test_long_texts(ranks):
    coder = bytebpe.Coder(bytebpe.ranks_text())
    prose = "the river and the harbour, l'été 1234 日本 \n\n x" * 5000
    assert coder.encode(prose) == coder.split.encode_ordinary(prose)
    # Runs over which the library's pattern engine runs out of stack, and one match of a megabyte.
    for text in (" " * 2_000_000 + "x", "\n " * 600_000, "ab" * 500_000, "a  " + " " * 1_500_000 + "\tq"):
        assert coder.decode(coder.encode(text)) == text.encode()
    short = "  \n" * 1400  # beyond LONG_RUN, within the engine's reach
    assert coder.encode("word" * 20_000 + short + "x") == coder.split.encode_ordinary("word" * 20_000 + short + "x")


def test_hard_rows(documents):
    found = bytebpe.digests(bytebpe.encode(documents(hard_rows(), clash=True))).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in hard_rows())
    for row, given in zip(
        sorted(found, key=lambda r: (str(r["doc_id"]), r["decoded_sha256"])),
        sorted(hard_rows(), key=lambda r: (str(r[0]), hashlib.sha256((r[1] or "").encode()).hexdigest())),
        strict=True,
    ):
        assert row["decoded_sha256"] == hashlib.sha256((given[1] or "").encode()).hexdigest()
        if not given[1]:
            assert row["n_tokens"] == 0 and row["ids_sha256"] == nothing
    assert bytebpe.digests(bytebpe.encode(documents([]))).collect() == []


def test_null_ids_and_cut_characters(spark):
    coder = bytebpe.Coder(bytebpe.ranks_text())
    cut = coder.single.encode_ordinary("語")[:1]
    rows = spark.createDataFrame([(1, None), (2, []), (3, cut)], "doc_id long, ids array<int>")
    back = {r["doc_id"]: r["bytes"] for r in bytebpe.decode(rows).collect()}
    assert back[1] is None and back[2] == b"" and back[3] == coder.decode(cut)
    told = {r["doc_id"]: r for r in bytebpe.digests(rows).collect()}
    assert told[1]["n_tokens"] is None and told[2]["n_tokens"] == 0
