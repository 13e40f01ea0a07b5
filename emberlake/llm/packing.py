"""Vector best-fit packing of token pieces into sequences.

Documents become token ids and an end id; only a document longer than a sequence is cut. A piece asks
for a vector: its tokens, one document, its attention cost (length squared). A sequence has a capacity
for each. Pieces go in by falling size; of the open sequences that hold the piece under every
constraint, the one with the least weighted norm of what would remain (``score="norm"``) or with the
greatest weighted dot product of demand and residual (``score="dot"``) takes it.

Scale: pieces are dealt at random into groups of about ``group_pieces`` and packed group by group, so a
task's memory is bounded, and a group wastes less than one sequence. Only the number of pieces, one
integer, reaches the driver; the tokenizer's file, of fixed size, is broadcast.

Defined results: null text is empty and gives one piece, the end id alone; a repeated row is packed
again; a null id stays null; an empty table gives no pieces. A piece over a capacity by itself raises.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import fresh, kept, tidy

SEQUENCE = 4096
GROUP_PIECES = 8192
#: Signs that are split and lowered alike by any version of the character tables.
_PLAIN = "\t\n\r -~\u00a1-\u02ff\u0370-\u03a2\u03a4-\u052f"
#: Text with others, or not in normal form C, is encoded by the tokenizer's own library.
_ODD = re.compile(f"[^{_PLAIN}]")
#: The split pattern that ``_split`` knows, and its contractions.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d"
#: Stands for the end of a word; no plain text holds it.
_END = "\x01"


def tokenizer_text(path: str | None = None) -> str:
    """The tokenizer's file; by default the public 49k word BPE."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def _split(pattern: str) -> Callable[[str], list[str]]:
    """All matches of the split pattern in a plain, lowered text."""
    if pattern != _SPLIT:
        import regex

        return regex.compile(pattern).findall
    plain = re.compile(f"[{_PLAIN}]")
    signs = sorted({x for c in map(chr, range(0x530)) if plain.match(c) for x in c.lower()})
    letters, numbers = (
        "".join(re.escape(c) for c in signs if unicodedata.category(c)[0] == kind) for kind in ("L", "N")
    )
    return re.compile(rf"{_CONTRACTIONS}|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+").findall


class Encoder:
    """Whole-text ids. Plain texts are lowered and split here and merged by the faster tiktoken library: a word
    gets an end sign, which its last byte takes up before all merges, as the vocabulary has word ends."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        rule = json.loads(definition)
        self.special = re.compile("|".join(re.escape(t["content"].lower()) for t in rule["added_tokens"]) or "(?!)").search
        self.merge = self._merger(rule)
        self.split = _split(rule["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def _merger(self, rule: dict):
        """The merges as ranks for bytes and an end sign, and the id of each rank."""
        import tiktoken

        suffix = rule["model"]["end_of_word_suffix"]
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        signs = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*own}))}
        end = _END.encode()

        def raw(token: str) -> bytes:
            word = token.removesuffix(suffix)
            return bytes(signs[c] for c in word) + (end if word != token else b"")

        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + end: 256 + b for b in range(256)}
        for merge in rule["model"]["merges"]:
            pair = merge if isinstance(merge, list) else merge.split(" ")
            ranks.setdefault(raw("".join(pair)), len(ranks))
        self.ids = np.zeros(len(ranks), "<u4")
        special = {t["content"] for t in rule["added_tokens"]}
        for token, i in rule["model"]["vocab"].items():
            if token not in special:
                self.ids[ranks[raw(token)]] = i
        return tiktoken.Encoding("words", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for text in texts:
            lower = text.lower()
            if _ODD.search(text) or not unicodedata.is_normalized("NFC", text) or self.special(lower):
                yield self.whole(text)
            elif words := self.split(lower):
                yield self.ids[self.merge.encode_ordinary(_END.join(words) + _END)].tobytes()
            else:
                yield b""


def tokenize_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    sequence: int = SEQUENCE,
    end_id: int = 1,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if asked for, the ids as an array."""
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(__name__, (definition.value.encode(),), lambda: Encoder(definition.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, cols = [], [[], [], [], []]
                ids_out = []
                for i, ids in enumerate(encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    for k, a in enumerate(range(0, len(ids), width)):
                        own = ids[a : a + width]
                        rows.append(i)
                        for col, v in zip(cols, (k, a // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                            col.append(v)
                        if with_ids:
                            ids_out.append(np.frombuffer(own, "<i4"))
                arrays = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32())]
                arrays += [pa.array(c, pa.int64()) for c in cols[1:]]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(arrays, names=names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), schema)


def best_fit(demands: np.ndarray, capacity: np.ndarray, weights: np.ndarray, score: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item, and the items in the order in which they were placed."""
    demands = demands / capacity
    if len(demands) and demands.max() > 1 + 1e-12:
        raise ValueError("a piece is over a capacity by itself")
    order = np.lexsort((np.arange(len(demands)), -(demands @ weights)))
    least = demands.min(axis=0) if len(demands) else None
    bins = np.empty(len(demands), np.int64)
    left = np.empty((len(demands), demands.shape[1]))  # residuals of the open bins, in the first ``n`` rows
    names = np.empty(len(demands), np.int64)
    n = made = 0
    slack = 1e-12
    for item in order:
        need = demands[item]
        rest = left[:n] - need
        fits = (rest >= -slack).all(axis=1)
        if fits.any():
            value = (rest * rest) @ weights if score == "norm" else -(left[:n] * need) @ weights
            value[~fits] = np.inf
            at = int(np.argmin(value))
            left[at] = rest[at]
        else:
            at, n = n, n + 1
            left[at] = 1 - need
            names[at] = made
            made += 1
        bins[item] = names[at]
        if (left[at] < least - slack).any():  # nothing fits any more
            n -= 1
            left[at], names[at] = left[n], names[n]
    return bins, order


def pack(
    pieces: DataFrame,
    length_col: str = "length",
    sequence: int = SEQUENCE,
    documents: int | None = None,
    attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001),
    score: str = "norm",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``pieces`` (a stored table) with sequence_id and offset, which replace columns of these names. ``documents`` and ``attention`` bound the
    pieces and the summed squared lengths of a sequence; without them they don't bind."""
    capacity = np.array([sequence, documents or sequence, attention or sequence * sequence], float)
    weight = np.array(weights, float)
    if score not in ("norm", "dot"):
        raise ValueError("score is norm or dot")
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    dealt_to = fresh("group", columns)
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn(dealt_to, (F.rand(17) * groups).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        size = rows[length_col].to_numpy(np.int64)
        demands = np.stack([size, np.ones_like(size), size * size], axis=1).astype(float)
        bins, order = best_fit(demands, capacity, weight, score)
        place = np.lexsort((np.argsort(order), bins))  # by bin, then as placed
        before = np.cumsum(size[place]) - size[place]
        first = np.r_[True, np.diff(bins[place]) != 0] if len(place) else np.empty(0, bool)
        offset = np.empty(len(size), np.int64)
        offset[place] = before - np.maximum.accumulate(np.where(first, before, 0))
        group = int(rows[dealt_to].iloc[0])
        return rows[columns].assign(sequence_id=(group << 32) + bins, offset=offset)

    return dealt.groupBy(dealt_to).applyInPandas(run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """The token sequences: sequence_id and its ids in order. A group is at most one sequence long."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", F.col(ids_col).alias("ids")))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
