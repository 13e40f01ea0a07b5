"""Byte-level BPE by the tiktoken library and a local rank file: texts to ids, and ids back to bytes.

A text is split by the pattern, and each match is merged by the ranks; special tokens do not exist, their
strings are plain text. A long text is encoded in segments. A segment ends where no match can go on: before
white space that follows another sign. A long run of white space, over which the library's pattern engine
would run out of stack, is one match by the pattern's rule (all of the run at the end of the text, else all
but its last sign) and is merged as one. Decoding returns raw bytes, so ids that cut a character are no error.

Scale: one pass, no shuffle. The rank file, of fixed size, is broadcast. A task holds one slice of about 1 MB
of text, or one longer text with its ids, and never the library's objects for more than a segment.

Defined results: null and empty texts have no ids; null ids decode to null; an id without a token raises; a
null document id stays null; repeated rows are encoded again; an empty table gives no rows. Other columns are
not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import kept, text_slices, tidy

#: Signs of a text that are encoded together.
SEGMENT = 1 << 16
#: White space of this length is taken out as a match of its own.
LONG_RUN = 1 << 12
#: Ids that are decoded together.
DECODE_IDS = 1 << 16

#: The characters with the property White_Space.
WHITE = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

_RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")
_EDGE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")


def ranks_text(path: str | None = None) -> bytes:
    """The rank file; by default the public one for many languages."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        return file.read()


def segments(text: str, limit: int = SEGMENT) -> Iterator[tuple[str, bool]]:
    """The segments of ``text`` in order, and whether one is a single match."""
    if len(text) <= limit:
        yield text, False
        return
    at = 0
    for run in _RUN.finditer(text):
        yield from _stretch(text, at, run.start(), limit)
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : at], True
    yield from _stretch(text, at, len(text), limit)


def _stretch(text: str, at: int, end: int, limit: int) -> Iterator[tuple[str, bool]]:
    while end - at > limit:
        edge = _EDGE.search(text, at + limit, end)
        if not edge:
            break
        yield text[at : edge.start()], False
        at = edge.start()
    if at < end:
        yield text[at:end], False


class Coder:
    """Both directions of one rank file."""

    def __init__(self, definition: bytes, pattern: str | None = None):
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, definition.splitlines())}
        pattern = pattern or public_tokenizers.PATTERN
        self.split = tiktoken.Encoding("split", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.single = tiktoken.Encoding("single", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if len(text) <= SEGMENT:
            return self.split.encode_ordinary(text)
        out: list[int] = []
        for part, one_match in segments(text):
            out += (self.single if one_match else self.split).encode_ordinary(part)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return self.split.decode_bytes(ids)


def coder(definition: Broadcast) -> Coder:
    """One coder a worker process, whatever the number of its tasks."""
    return kept(__name__, (definition.value,), lambda: Coder(definition.value))


def _ranks(spark: SparkSession, ranks_path: str | None) -> Broadcast:
    return spark.sparkContext.broadcast(ranks_text(ranks_path))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """``id_col`` and ``ids`` of every row."""
    definition = _ranks(docs.sparkSession, ranks_path)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(definition)
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                ids = [np.array(own.encode(t), np.int32) for t in texts.to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield pa.record_batch(
                    [batch.column(0).slice(at, len(ids)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=[id_col, "ids"],
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), f"`{id_col}` {id_type}, ids array<int>")


def _rows_of_ids(column: pa.Array) -> Iterator[tuple[int, int | None]]:
    """Where each row's ids lie in the column's flat values; the end is None for a null row."""
    starts, valid = column.offsets.to_numpy(), column.is_valid().to_pylist()
    for row, ok in enumerate(valid):
        yield int(starts[row]), int(starts[row + 1]) if ok else None


def _decoded(own: Coder, values: np.ndarray, start: int, end: int) -> Iterator[tuple[list[int], bytes]]:
    """The ids between two places, some at a time, with their bytes."""
    for at in range(start, end, DECODE_IDS):
        ids = values[at : min(at + DECODE_IDS, end)].tolist()
        yield ids, own.decode(ids)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """``id_col`` and ``bytes``, the raw bytes of every row's ids."""
    definition = _ranks(encoded.sparkSession, ranks_path)
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(definition)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = part.column(1).values.to_numpy()
                out = [
                    None if end is None else b"".join(raw for _, raw in _decoded(own, values, start, end))
                    for start, end in _rows_of_ids(part.column(1))
                ]
                yield pa.record_batch([part.column(0), pa.array(out, pa.binary())], names=[id_col, "bytes"])

    rows = encoded.select(F.col(id_col), F.col(ids_col).cast("array<int>"))
    return rows.mapInArrow(tidy(run), f"`{id_col}` {id_type}, bytes binary")


def digests(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """What tells two encodings apart, without the bytes of a long text in memory at once: ``n_tokens``,
    ``ids_sha256`` of the decimal ids joined by commas, ``decoded_sha256`` of the decoded bytes."""
    definition = _ranks(encoded.sparkSession, ranks_path)
    id_type = encoded.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(definition)
        for batch in batches:
            column = batch.column(1)
            values = column.values.to_numpy()
            cols = [[], [], []]
            for start, end in _rows_of_ids(column):
                if end is None:
                    for col in cols:
                        col.append(None)
                    continue
                of_ids, of_bytes, comma = hashlib.sha256(), hashlib.sha256(), ""
                for ids, raw in _decoded(own, values, start, end):
                    of_ids.update((comma + ",".join(map(str, ids))).encode())
                    of_bytes.update(raw)
                    comma = ","
                for col, value in zip(cols, (end - start, of_ids.hexdigest(), of_bytes.hexdigest()), strict=True):
                    col.append(value)
            yield pa.record_batch(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = encoded.select(F.col(id_col), F.col(ids_col).cast("array<int>"))
    return rows.mapInArrow(tidy(run), schema)
