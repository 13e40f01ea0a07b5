"""Which tokens of two tokenizers cover the same bytes of a text.

Tokens of both, A (byte-level BPE) and B (sentence pieces), cut the same bytes: a space and the text. Incidence
matrices, tokens by bytes, are held as rows of compressed sparse columns (``Csr``). Gustavson's row by row
product A·Bᵀ gives the overlap links: a pair of tokens is linked by as many bytes as they share. Byte offsets
where tokens of both end cut the tokens into groups; the incidence matrices of groups, G_Aᵀ·G_B, give the links of
tokens that share a group. Over all documents, an id pair counts once for each document that holds it linked.

Scale: documents are aligned in one pass, in chunks of about 1 MB of text; a longer text is cut before spaces that
stand between other signs, where tokens of both end. Its links, id pairs and group texts are added up, so the
products never see more than a chunk. Counts are a grouped aggregation, with partial sums on the map side. To rate
the links, pairs that hold more than 1/HOT_PAIRS of all (document, pair) entries (at most HOT_PAIRS by that
definition) are broadcast, and the others, none of them hot, are joined by a shuffle. No table is collected.

Defined results: a text that is null, empty or that the two do not both spell byte by byte has no tokens: zeros and
an empty group text. Null ids stay; repeated rows are documents of their own; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import kept, materialize, text_slices, tidy

#: Characters of a long text that are aligned together.
CHUNK = 1 << 19
#: The most id pairs that are broadcast.
HOT_PAIRS = 200_000
#: Pairs of tokens of one block of a product.
BLOCK_LINKS = 1 << 20
#: A place where every token of both ends: a space between other signs. The white space of the
#: pattern of A, as code points.
_BLANKS = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_EDGE = re.compile(f"(?<=[^{_BLANKS}]) (?=[^{_BLANKS}])")
#: Texts of these characters alone are split alike by any version of the character classes.
_ODD = re.compile("[^\t\n\r -~¡-˿Ͱ-ͳͶͷͻ-Ϳ΄-ΊΎ-ΡΣ-ԯ]")


# ---- sparse products ----


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: row i has ``data[k]`` in column ``indices[k]`` for k from ``indptr[i]`` to
    ``indptr[i + 1]``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def row_of(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))

    def transpose(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.zeros(self.columns + 1, np.int64)
        np.cumsum(np.bincount(self.indices, minlength=self.columns), out=indptr[1:])
        return Csr(indptr, self.row_of()[order], self.data[order], self.rows)

    def block(self, start: int, stop: int) -> Csr:
        """Rows from ``start`` to ``stop``."""
        a, b = self.indptr[start], self.indptr[stop]
        return Csr(self.indptr[start : stop + 1] - a, self.indices[a:b], self.data[a:b], self.columns)

    def dense(self) -> np.ndarray:
        out = np.zeros((self.rows, self.columns), self.data.dtype)
        np.add.at(out, (self.row_of(), self.indices), self.data)
        return out


def runs(ends: np.ndarray, columns: int) -> Csr:
    """Ones where row i covers the columns from the end of row i - 1 up to its own end."""
    return Csr(np.concatenate(([0], ends)).astype(np.int64), np.arange(columns), np.ones(columns, np.int64), columns)


def products_by_row(left: Csr, right: Csr) -> np.ndarray:
    """How many products Gustavson's algorithm forms for each row of ``left @ right``."""
    before = np.zeros(len(left.indices) + 1, np.int64)
    np.cumsum(np.diff(right.indptr)[left.indices], out=before[1:])
    return before[left.indptr[1:]] - before[left.indptr[:-1]]


def gustavson(left: Csr, right: Csr) -> Csr:
    """``left @ right``: every entry (i, k) of ``left`` adds its multiple of row k of ``right`` to row i, and
    products of one column are added up. All rows are formed together, in order."""
    width = np.diff(right.indptr)[left.indices]
    total = int(width.sum())
    # Entry e of the expansion is number e - first of its row of ``right``.
    first = np.cumsum(width) - width
    if total == len(width) and (width == 1).all():
        source, rows, scale = right.indptr[left.indices], left.row_of(), left.data
    else:
        source = np.arange(total) + np.repeat(right.indptr[left.indices] - first, width)
        rows, scale = np.repeat(left.row_of(), width), np.repeat(left.data, width)
    columns, values = right.indices[source], scale * right.data[source]
    key = rows * max(right.columns, 1) + columns
    if total and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if total else np.empty(0, np.int64)
    rows, columns = np.divmod(key[new], max(right.columns, 1))
    indptr = np.zeros(left.rows + 1, np.int64)
    np.cumsum(np.bincount(rows, minlength=left.rows), out=indptr[1:])
    return Csr(indptr, columns, np.add.reduceat(values, new) if total else values, right.columns)


# ---- the two tokenizers ----


def tokenizer_files(a_path: str | None = None, b_path: str | None = None) -> tuple[bytes, bytes]:
    """The two definitions; by default the public 50k byte BPE and the 32k pieces."""
    import public_tokenizers

    with open(a_path or public_tokenizers.path("byte_bpe_50k.json"), "rb") as a:
        with open(b_path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
            return a.read(), b.read()


def _byte_signs() -> dict[str, int]:
    """The printable sign of each byte in a byte-level vocabulary: printable Latin-1 bytes stand for
    themselves, the others for the signs from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_definition: bytes, b_definition: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_definition.decode())
        self.a.encode_special_tokens = True
        signs = _byte_signs()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        special = {t["content"] for t in json.loads(a_definition)["added_tokens"]}
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(signs[c] for c in token)
        self.fast = self._ranked(a_definition, special)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_definition)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.fast_b = self._scored()
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # A token's text after the mark that stands before it.
        self.a_first = [f";{i}" for i in range(len(self.a_bytes))]
        self.a_more = [f",{i}" for i in range(len(self.a_bytes))]
        self.b_first = [f"|{i}" for i in range(len(self.b_bytes))]
        self.b_more = [f",{i}" for i in range(len(self.b_bytes))]

    def _ranked(self, definition: bytes, special: set[str]):
        """The vocabulary of A as ranks for the faster library, if ids are in the order of merges; the two
        then merge alike, and split alike where the character classes are beyond doubt."""
        import public_tokenizers
        import tiktoken

        rule = json.loads(definition)
        merges = [m if isinstance(m, list) else m.split(" ") for m in rule["model"]["merges"]]
        vocabulary = rule["model"]["vocab"]
        made = [vocabulary.get("".join(m)) for m in merges]
        plain = {i: self.a_bytes[i] for t, i in vocabulary.items() if t not in special}
        in_order = all(x is not None for x in made) and made == sorted(made) and len(plain) == 256 + len(merges)
        if not in_order or rule["pre_tokenizer"].get("type") != "ByteLevel" or rule.get("normalizer"):
            return None
        ranks = {token: i for i, token in plain.items()}
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _scored(self):
        """B's pieces of plain characters as ranks for the faster library, and the piece of each rank; None if
        the two would not merge alike. Characters are merged of their bytes before all else, then pieces by falling
        score. A piece is left out that B itself never makes of its text."""
        import tiktoken

        signs = "".join(map(chr, range(0x530)))
        plain = [c for c in signs if not _ODD.match(c)]
        normal = [
            i for i in range(len(self.b_bytes))
            if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))
        ]
        pieces = {self.b.id_to_piece(i): i for i in normal}
        # Pieces of equal score, as runs of spaces are, merge from the left: texts that can hold one are left to B.
        often = Counter(self.b.get_score(i) for p, i in pieces.items() if len(p) > 1)
        tied = {p for p, i in pieces.items() if len(p) > 1 and often[self.b.get_score(i)] > 1}
        spelt = self.b.encode([c + "x" for c in plain])
        alike = all(b"".join(self.b_bytes[i] for i in ids) == f" {c}x".encode() for c, ids in zip(plain, spelt))
        if not alike or any(set(p) != {"\u2581"} for p in tied) or any("\u2581" in p.lstrip("\u2581") for p in pieces):
            return None
        first = [p for p in pieces if p.startswith("\u2581")]
        made = self.b.encode([p[1:].replace("\u2581", " ") for p in first])
        never = {p for p, ids in zip(first, made) if ids != [pieces[p]]}
        ranks, ids = {}, []

        def rank(raw: bytes, i: int) -> None:
            if raw not in ranks:
                ranks[raw] = len(ids)
                ids.append(i)

        for b in range(256):
            rank(bytes([b]), pieces.get({" ": "\u2581"}.get(chr(b), chr(b)) if b < 128 else "", self.b.piece_to_id(f"<0x{b:02X}>")))
        for c in plain:
            if c in pieces:
                rank(c.encode(), pieces[c])
        longer = [p for p in pieces if len(p) > 1 and p not in never | tied and not _ODD.search(p.replace("\u2581", " "))]
        for p in sorted(longer, key=lambda p: -self.b.get_score(pieces[p])):
            rank(p.replace("\u2581", " ").encode(), pieces[p])
        self.b_of_rank = np.array(ids, np.int64)
        return tiktoken.Encoding("b", pat_str=" *[^ ]+| +", mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, whole: str) -> Sequence[int]:
        if self.fast is None or _ODD.search(whole):
            return self.a.encode(whole, add_special_tokens=False).ids
        return self.fast.encode_ordinary(whole)

    def encode_b(self, whole: str) -> Sequence[int]:
        """``whole`` begins with the space that B adds itself."""
        if self.fast_b is None or "  " in whole or _ODD.search(whole):
            return self.b.encode(whole[1:], num_threads=1)
        return self.b_of_rank[self.fast_b.encode_ordinary(whole)]

    def spells(self, whole: str, a: Sequence[int], b: Sequence[int]) -> bool:
        """Whether both token sequences are the bytes of the text."""
        raw = whole.encode()
        return all(b"".join(map(own.__getitem__, ids)) == raw for own, ids in ((self.a_bytes, a), (self.b_bytes, b)))


def pair(definitions: Broadcast) -> Pair:
    """One pair a worker process."""
    return kept(__name__, definitions.value, lambda: Pair(*definitions.value))


# ---- one chunk of texts ----


@dataclass
class Aligned:
    """Several texts laid end to end; ``a_ends`` and ``b_ends`` are byte offsets, ``a_at`` and ``b_at`` say
    where each text's tokens begin. A text without tokens has none in either."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray

    @property
    def size(self) -> int:
        return int(self.a_ends[-1]) if len(self.a_ends) else 0

    def overlap(self) -> Csr:
        """A·Bᵀ of the token by byte matrices: shared bytes of the tokens of A (rows) and B."""
        return gustavson(runs(self.a_ends, self.size), runs(self.b_ends, self.size).transpose())

    def groups(self) -> tuple[Csr, Csr]:
        """The group by token matrices of A and of B."""
        common = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        return (
            runs(np.searchsorted(self.a_ends, common) + 1, len(self.a)),
            runs(np.searchsorted(self.b_ends, common) + 1, len(self.b)),
        )

    def shared(self) -> Iterator[tuple[int, Csr]]:
        """G_Aᵀ·G_B: tokens of A (rows) and B in one group, in blocks of rows of bounded size; with each
        block its first row."""
        of_a, of_b = self.groups()
        left = of_a.transpose()
        formed = np.cumsum(products_by_row(left, of_b))
        start = 0
        while start < left.rows:
            limit = BLOCK_LINKS + (formed[start - 1] if start else 0)
            stop = max(start + 1, int(np.searchsorted(formed, limit, "right")))
            yield start, gustavson(left.block(start, stop), of_b)
            start = stop


def align_texts(own: Pair, wholes: list[str]) -> tuple[Aligned, list[bool]]:
    """Aligns texts that begin with the space; and which of them both tokenizers spell."""
    found = [(np.array(own.encode_a(w), np.int64), np.array(own.encode_b(w), np.int64)) for w in wholes]
    # The faster library cuts a text's bytes, so what it makes spells the text.
    checked = own.fast is None or own.fast_b is None
    spelt = [
        own.spells(w, a, b) if checked or "  " in w or _ODD.search(w) else True for w, (a, b) in zip(wholes, found, strict=True)
    ]
    none = np.empty(0, np.int64)
    out = []
    for side, sizes in ((0, own.a_sizes), (1, own.b_sizes)):
        ids = [one[side] if ok else none for one, ok in zip(found, spelt, strict=True)]
        flat = np.concatenate([none, *ids])
        out.append((flat, np.cumsum(sizes[flat]), np.array([0, *accumulate(map(len, ids))], np.int64)))
    (a, a_ends, a_at), (b, b_ends, b_at) = out
    return Aligned(a, b, a_ends, b_ends, a_at, b_at), spelt


def group_texts(own: Pair, chunk: Aligned) -> list[str]:
    """Of each text, the ids of its groups: ``a1,a2|b1;a3|b2,b3``."""
    of_a, of_b = chunk.groups()
    n_a, n_b = len(chunk.a), len(chunk.b)
    # In order: the A tokens of a group, its B tokens, the next group.
    order = np.empty(n_a + n_b, np.int64)
    a_group, b_group = of_a.row_of(), of_b.row_of()
    order[np.arange(n_a) + of_b.indptr[a_group]] = np.arange(n_a)
    order[np.arange(n_b) + of_a.indptr[b_group + 1]] = np.arange(n_b) + n_a
    first = np.zeros(n_a + n_b, bool)
    first[of_a.indptr[:-1]] = True
    first[of_b.indptr[:-1] + n_a] = True
    tables = (own.a_more, own.a_first, own.b_more, own.b_first)
    bases = np.cumsum([0, *map(len, tables[:-1])])
    marks = own.__dict__.setdefault("marks", [x for table in tables for x in table])
    kind = 2 * (np.arange(n_a + n_b) >= n_a) + first
    code = (bases[kind] + np.concatenate((chunk.a, chunk.b)))[order].tolist()
    at = (chunk.a_at + chunk.b_at).tolist()
    return ["".join(map(marks.__getitem__, code[i:j]))[1:] for i, j in zip(at, at[1:])]


#: Id pairs of a text are numbers a * B_SPAN + b.
B_SPAN = 1 << 31


@dataclass
class Rows:
    """What is known of each text of a chunk."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    n_shared: np.ndarray
    groups: list[str]
    pairs: list[tuple[np.ndarray, np.ndarray]]  # distinct id pairs, and the links of each


def describe(own: Pair, chunk: Aligned) -> Rows:
    links = chunk.overlap()
    of_a, of_b = chunk.groups()
    rows = len(chunk.a_at) - 1
    a_text = np.repeat(np.arange(rows), np.diff(chunk.a_at))
    shared = products_by_row(of_a.transpose(), of_b)

    def by_text(weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(weights)))
        return sums[chunk.a_at[1:]] - sums[chunk.a_at[:-1]]

    begins = np.zeros(len(chunk.a), np.int64)
    begins[of_a.indptr[:-1]] = 1
    row = links.row_of()
    text, key = a_text[row], chunk.a[row] * B_SPAN + chunk.b[links.indices]
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (key[1:] != key[:-1]))) if len(key) else np.empty(0, bool)
    new = np.flatnonzero(new)
    count = np.diff(np.concatenate((new, [len(key)])))
    cut = np.searchsorted(text[new], np.arange(rows + 1))
    key = key[new]
    return Rows(
        np.diff(chunk.a_at),
        np.diff(chunk.b_at),
        by_text(begins),
        by_text(np.diff(links.indptr)),
        by_text(shared),
        group_texts(own, chunk),
        [(key[i:j], count[i:j]) for i, j in zip(cut, cut[1:])],
    )


def chunks_of(whole: str, limit: int = CHUNK) -> Iterator[str]:
    """``whole`` cut before spaces that stand between other signs."""
    at = 0
    while len(whole) - at > limit:
        edge = _EDGE.search(whole, at + limit)
        if not edge:
            break
        yield whole[at : edge.start()]
        at = edge.start()
    yield whole[at:]


def describe_long(own: Pair, whole: str) -> Rows:
    """As ``describe`` of one text, chunk by chunk."""
    parts = []
    for piece in chunks_of(whole):
        chunk, spelt = align_texts(own, [piece])
        if not spelt[0]:
            chunk, _ = align_texts(own, [])
            return describe(own, Aligned(chunk.a, chunk.b, chunk.a_ends, chunk.b_ends, np.zeros(2, np.int64), np.zeros(2, np.int64)))
        parts.append(describe(own, chunk))
    key, place = np.unique(np.concatenate([p.pairs[0][0] for p in parts]), return_inverse=True)
    count = np.bincount(place, np.concatenate([p.pairs[0][1] for p in parts]), len(key)).astype(np.int64)
    sums = [sum(getattr(p, name) for p in parts) for name in ("n_a", "n_b", "n_groups", "n_links", "n_shared")]
    return Rows(*sums, [";".join(p.groups[0] for p in parts)], [(key, count)])


# ---- tables ----


def _definitions(spark: SparkSession, a_path: str | None, b_path: str | None) -> Broadcast:
    return spark.sparkContext.broadcast(tokenizer_files(a_path, b_path))


_PAIR_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("links", pa.int32())]))


def _batch(ids: pa.Array, found: Rows, id_col: str) -> pa.RecordBatch:
    key = np.concatenate([np.empty(0, np.int64), *(k for k, _ in found.pairs)])
    count = np.concatenate([np.empty(0, np.int64), *(c for _, c in found.pairs)])
    a, b = np.divmod(key, B_SPAN)
    entries = pa.StructArray.from_arrays(
        [pa.array(x.astype(np.int32)) for x in (a, b, count)], fields=list(_PAIR_TYPE.value_type)
    )
    offsets = pa.array([0, *accumulate(len(k) for k, _ in found.pairs)], pa.int32())
    arrays = [pa.array(x, pa.int64()) for x in (found.n_a, found.n_b, found.n_groups, found.n_links, found.n_shared)]
    arrays += [pa.array(found.groups, pa.string()), pa.ListArray.from_arrays(offsets, entries)]
    names = ["n_a", "n_b", "n_groups", "n_links", "n_shared", "groups", "pairs"]
    return pa.record_batch([ids, *arrays], names=[id_col, *names])


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
) -> DataFrame:
    """Per row: ``n_a, n_b`` tokens, ``n_groups``, ``n_links`` by shared bytes, ``n_shared`` links by shared
    groups, ``groups`` as text, and ``pairs``, the distinct linked ids with the links of each."""
    definitions = _definitions(docs.sparkSession, a_path, b_path)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups string"
    schema += ", pairs array<struct<a:int,b:int,links:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(definitions)
        for batch in batches:
            for at, texts in text_slices(batch.column(1), CHUNK):
                ids, texts = batch.column(0).slice(at, len(texts)), texts.to_pylist()
                if len(texts) == 1 and len(texts[0]) > CHUNK:
                    yield _batch(ids, describe_long(own, " " + texts[0]), id_col)
                else:
                    # An empty text has no tokens, not the token of the space.
                    wholes = [" " + t for t in texts if t]
                    chunk, _ = align_texts(own, wholes)
                    kept = np.concatenate(([0], np.cumsum([bool(t) for t in texts])))
                    chunk.a_at, chunk.b_at = chunk.a_at[kept], chunk.b_at[kept]
                    yield _batch(ids, describe(own, chunk), id_col)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), schema)


def links(
    docs: DataFrame,
    kind: str = "overlap",
    id_col: str = "doc_id",
    text_col: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
) -> DataFrame:
    """One row a link of two tokens: their positions in the row's A and B tokens, their ids, and ``weight``:
    shared bytes (``overlap``), or 1 for tokens of one group (``group``)."""
    if kind not in ("overlap", "group"):
        raise ValueError("kind is overlap or group")
    definitions = _definitions(docs.sparkSession, a_path, b_path)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, a_at long, b_at long, a int, b int, weight long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(definitions)
        for batch in batches:
            for row, text in enumerate(batch.column(1).to_pylist()):
                made, spelt = [], bool(text)
                if text:
                    for piece in chunks_of(" " + text):
                        chunk, ok = align_texts(own, [piece])
                        spelt = spelt and ok[0]
                        made.append(chunk)
                a_before = b_before = 0
                for chunk in made if spelt else ():
                    for start, found in [(0, chunk.overlap())] if kind == "overlap" else chunk.shared():
                        a, b = found.row_of() + start, found.indices
                        yield pa.record_batch(
                            [
                                batch.column(0).take(pa.array(np.full(len(a), row))),
                                pa.array(a + a_before),
                                pa.array(b + b_before),
                                pa.array(chunk.a[a].astype(np.int32)),
                                pa.array(chunk.b[b].astype(np.int32)),
                                pa.array(found.data),
                            ],
                            names=[id_col, "a_at", "b_at", "a", "b", "weight"],
                        )
                    a_before, b_before = a_before + len(chunk.a), b_before + len(chunk.b)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``a, b, docs, best`` of (row, a, b) entries: how many rows hold the pair, and whether no other pair of
    that A id is held by more."""
    counts = materialize(pairs.groupBy("a", "b").agg(F.count("*").alias("docs")))
    # At most one row an id of A's vocabulary.
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    return counts.join(F.broadcast(top), "a").select("a", "b", "docs", (F.col("docs") == F.col("top")).alias("best"))


def rate(aligned: DataFrame, row_col: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``row_col``, ``n_best`` and ``count_sum`` of the rows of a stored ``aligned`` that have links."""
    pairs = aligned.select(F.col(row_col), F.inline("pairs"))
    rated = materialize(pair_counts(pairs))
    entries = rated.agg(F.sum("docs")).first()[0] or 0
    # Counts add up to ``entries``, so at most ``hot_pairs`` of them are above this.
    bound = entries / hot_pairs
    hot = F.broadcast(rated.filter(F.col("docs") > bound))
    cold = rated.filter(F.col("docs") <= bound)
    sums = [
        F.sum(F.col("links") * F.col("best").cast("long")).alias("n_best"),
        F.sum(F.col("links") * F.col("docs")).alias("count_sum"),
    ]
    of_hot = pairs.join(hot, ["a", "b"]).groupBy(row_col).agg(*sums)
    of_cold = pairs.join(hot, ["a", "b"], "left_anti").join(cold, ["a", "b"]).groupBy(row_col).agg(*sums)
    both = of_hot.unionByName(of_cold).groupBy(row_col)
    return both.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
