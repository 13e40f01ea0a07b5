"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.sources.shared import scratch_path

#: The white space of the word rule: space, and tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"
#: Bytes of text that the numpy helpers look at together.
SLICE_BYTES = 1 << 20

T = TypeVar("T")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = 0x9E3779B97F4A7C15 | 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: later jobs neither repeat
    its work nor lose it with an executor."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def drop_ids(rows: DataFrame, judged: DataFrame, stays: str, id_col: str = "doc_id") -> DataFrame:
    """``rows`` without those whose id has no judged row with ``stays``. An id without judgement stays."""
    name = fresh("dropped_id", rows.columns)
    gone = judged.groupBy(F.col(id_col).alias(name)).agg(F.bool_or(stays).alias("s")).filter("NOT s").select(name)
    gone = materialize(gone)
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return rows.join(gone, F.col(id_col).eqNullSafe(F.col(name)), "left_anti")


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_kept: dict = {}


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of 4 MB, unless the session says otherwise than Spark's 64 MB: a
    task holds several copies of a batch, in the JVM and in Python, and the operators cut it smaller still."""
    if spark.conf.get(_BATCH_BYTES, None) in (None, "64m", "67108864", "67108864b"):
        spark.conf.set(_BATCH_BYTES, "4m")


def release() -> None:
    """Gives freed memory of this process back to the system. Workers live on from task to task, and what the
    allocators keep of one stage would be added to the next one's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def kept(owner: str, definition: tuple[bytes, ...], make: Callable[[], T]) -> T:
    """What ``make`` makes of a definition, kept in the worker for the next tasks of the same operator."""
    key = (owner, hashlib.sha256(b"".join(definition)).digest())
    if _kept.get("key") != key:
        _kept.clear()
        _kept.update(key=key, value=make())
    return _kept["value"]


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, with the worker's freed memory given back at the end of each task, and what another operator
    has kept dropped before it."""
    owner = run.__module__

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _kept and _kept["key"][0] != owner:
            _kept.clear()
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def ascii_lower(column: Column) -> Column:
    return F.translate(column, _UPPER, _LOWER)


def words_of(column: Column) -> Column:
    """The words of the word rule, as an array: runs of anything but blanks, A-Z lowered."""
    return F.filter(F.split(ascii_lower(column), BLANK), lambda w: w != "")


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, a bijection on 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:  # doubles: base^(i + filled) = base^i * base^filled
        step = np.uint64(pow(base, filled, 1 << 64))
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * step
        filled += more
    return out


def blank_table() -> np.ndarray:
    """For each byte, what the word rule makes of it: 0 for a blank, else the lowered byte plus 1."""
    table = np.arange(1, 257, dtype=np.uint64)
    table[ord("A") + 0 : ord("Z") + 1] += np.uint64(32)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    return table


def letter_table() -> np.ndarray:
    """As ``blank_table``, but all ASCII except letters and digits separates words."""
    table = blank_table()
    plain = [b for b in range(128) if not chr(b).isalnum()]
    table[plain] = 0
    return table


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows of about ``limit`` bytes each (a longer text stands alone), with their first row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to


def hash_words(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all rows in order, and where each row's words begin (one more
    offset than rows). A word's hash depends on its bytes alone."""
    _, hashes, starts, _, _ = hash_runs(texts, table, table != 0)
    return hashes, starts


def hash_runs(
    texts: pa.Array, table: np.ndarray, kinds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``hash_words`` for runs of bytes of one kind (0: between runs): the bytes of all rows, hashes,
    offsets by row, and where in the bytes each run begins and ends."""
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = texts.buffers()[2]
    if data is None or ends[0] == ends[-1]:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint8), np.empty(0, np.uint64), np.zeros(n + 1, np.int64), none, none
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    code = table[raw]
    kind = kinds[raw]
    inside = kind != 0
    # A run begins where the kind changes or a row starts, and ends alike.
    turn = kind[1:] != kind[:-1]
    first = inside.copy()
    first[1:] &= turn
    last = inside.copy()
    last[:-1] &= turn
    cut = ends[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(code * powers(BASE, len(raw)), out=sums[1:])
    back = powers(inverse(BASE), len(raw))
    value = (sums[stop] - sums[start]) * back[start]
    return raw, mix64(value + (stop - start).astype(np.uint64)), np.searchsorted(start, ends), start, stop


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words, in order; all words as one if they are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(BASE) + words[i : i + len(out)]
    return mix64(out + np.uint64(size))
