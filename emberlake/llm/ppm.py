"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of the byte contexts of up to ``order`` bytes, with the counts of the bytes that follow.
A byte is predicted in its longest context that is in the trie: seen there with probability c / (n + d), else
escaped from with d / (n + d) (n counts, d distinct bytes), to the context one byte shorter, whose counts are
taken without the bytes excluded by the longer one. Behind the shortest all bytes left are equally likely. As
the same corpus filled all orders, the bytes of a context are among those of its shorter ones, so a context
carries all it needs for exclusion: how many of the shorter one's counts its bytes have.

The text that is coded is the tokens of the word rule with one blank between them, then an end.

Scale: a task counts the longest contexts of its rows in arrays and emits each once; shorter ones are sums of
these. The trie is broadcast in blocks by the last two context bytes, which keep all longer contexts together;
a block has about ``max_grams`` entries, and texts are read once for each block, so memory is bounded while
the trie grows with the corpus. Of the words' counts those of at least 1 / 2^20 of all tokens, a million
words at most, are broadcast; rarer tokens are joined with their counts by a shuffle on the word.

Defined results: null, empty and blank texts are one token, the end; repeated rows are scored alike (and
counted as often in training); a null id stays null; an empty table
gives an empty result; without training rows all bytes are equally likely and N and V are 0. Words are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import blank_table, hash_runs, materialize, text_slices

ORDER = 5
MAX_GRAMS = 4_000_000
FREQUENT_BITS = 20
_END, _SYMBOLS = 0x0A, 257
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
_GRAM, _WORD = 1, 2
#: Bytes of text coded together, and array entries held before they are merged, to bound a task's memory.
CODED_BYTES = 1 << 18
HELD_ENTRIES = 1_000_000


class Coded:
    """The canonical texts of some rows: ``codes`` (context and byte packed, the byte lowest) of all bytes
    in order, ``starts`` of the rows in them, and the rows' words."""

    def __init__(self, texts: pa.Array, order: int, table: np.ndarray):
        raw, self.words, self.word_starts, first, last = hash_runs(texts, table, table != 0)
        rows = len(texts)
        kept = np.zeros(len(raw), bool)
        values = np.empty(0, np.uint8)
        sizes = np.zeros(rows, np.int64)
        if len(raw):
            low = table[raw]
            kept = low != 0
            inner = np.ones(len(last), bool)  # words with another one behind them in their row
            ends = self.word_starts[1:][np.diff(self.word_starts) > 0] - 1
            inner[ends] = False
            kept[last[inner]] = True
            values = np.where(low == 0, 32, low - np.uint64(1)).astype(np.uint8)[kept]
            row_ends = np.frombuffer(texts.buffers()[1], np.int64, rows + 1, texts.offset * 8)
            counts = np.r_[0, np.cumsum(kept)]
            sizes = np.diff(counts[row_ends - row_ends[0]])
        whole = np.full(len(values) + rows * (order + 1), _END, np.uint8)
        row_of = np.repeat(np.arange(rows), sizes)
        whole[np.arange(len(values)) + order * (row_of + 1) + row_of] = values
        at = np.ones(len(whole), bool)  # all but the padding before each row
        begin = np.r_[0, np.cumsum(sizes + order + 1)[:-1]] if rows else np.empty(0, np.int64)
        at[(begin[:, None] + np.arange(order)).ravel()] = False
        wide = whole.astype(np.uint64)
        codes = np.zeros(max(len(whole) - order, 0), np.uint64)
        for j in range(order + 1):
            codes |= wide[j : j + len(codes)] << np.uint64(8 * (order - j))
        self.codes = codes[at[order:]]
        self.starts = np.r_[0, np.cumsum(sizes + 1)]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def count_corpus(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(kind, key, n): how often each longest context with its byte, and each word, stands in all texts.
    The end counts as a word of its own (key 0 of kind 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = blank_table()
        held: dict[int, tuple[list, list]] = {_GRAM: ([], []), _WORD: ([], [])}
        fresh = rows = 0
        for batch in batches:
            rows += batch.num_rows
            for _, part in text_slices(batch.column(0), CODED_BYTES):
                coded = Coded(part, order, table)
                for kind, values in ((_GRAM, coded.codes), (_WORD, coded.words)):
                    key, n = np.unique(values, return_counts=True)
                    held[kind][0].append(key)
                    held[kind][1].append(n)
                    fresh += len(key)
                if fresh > HELD_ENTRIES:
                    held = {k: tuple([x] for x in _merged(*v)) for k, v in held.items()}
                    fresh = 0
        if rows:
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([0], pa.int64()), pa.array([rows], pa.int64())], names=["kind", "key", "n"])
        for kind, lists in held.items():
            if lists[0]:
                key, n = _merged(*lists)
                for at in range(0, len(key), 100_000):
                    own = key[at : at + 100_000].view(np.int64)
                    yield pa.record_batch(
                        [pa.array(np.full(len(own), kind, np.int32)), pa.array(own), pa.array(n[at : at + 100_000])], names=["kind", "key", "n"]
                    )

    counts = docs.select(text_col).mapInArrow(run, "kind int, key long, n long")
    return materialize(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")))


class Trie:
    """Some contexts of every order, ready to code with. ``grams`` are the longest contexts and their byte,
    sorted, ``n`` their counts; ``pairs``, ``pair_n`` the contexts of one byte, of the whole corpus."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, pairs: np.ndarray, pair_n: np.ndarray, order: int):
        self.order = order
        levels = [(grams, n.astype(np.float64))]
        for k in range(order - 1, -1, -1):
            code, count = levels[-1] if k != 1 else (pairs, pair_n.astype(np.float64))
            levels.append(_merged([code & self.mask(k)], [count]))
        self.levels = []
        for i, (code, count) in enumerate(levels):
            first = np.flatnonzero(np.r_[True, (code[1:] >> np.uint64(8)) != (code[:-1] >> np.uint64(8))]) if len(code) else np.empty(0, np.int64)
            distinct = np.diff(np.r_[first, len(code)]).astype(np.float64)
            total = np.add.reduceat(count, first) if len(first) else np.empty(0)
            excluded = np.zeros(len(first))
            if i < order and len(first):
                lower, lower_n = levels[i + 1]
                excluded = np.add.reduceat(lower_n[np.searchsorted(lower, code & self.mask(order - i - 1))], first)
            self.levels.append((code, count, code[first] >> np.uint64(8), total, distinct, excluded))
        self._index()
        # The table tells which of the longest contexts' bytes were seen; the lists are not needed any more.
        self.levels[0] = (code[:0], count[:0], *self.levels[0][2:])

    @staticmethod
    def mask(k: int) -> np.uint64:
        return np.uint64((1 << (8 * (k + 1))) - 1)

    def _index(self) -> None:
        """A hash table of the longest contexts with their byte and its log10 probability."""
        code, count, context, total, distinct, _ = self.levels[0]
        at = np.searchsorted(context, code >> np.uint64(8))
        logs = np.log10(count / (total + distinct)[at]).astype(np.float32) if len(code) else np.empty(0, np.float32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(code)) * 1.6))))
        self.keys = np.full(1 << self.bits, _FREE)
        self.logs = np.zeros(1 << self.bits, np.float32)
        slot, left = self.slot(code), np.arange(len(code))
        while len(left):
            free = self.keys[slot[left]] == _FREE
            who = left[free]
            self.keys[slot[who]] = code[who]  # of several that want one slot the last stays
            won = self.keys[slot[left]] == code[left]
            self.logs[slot[left[won]]] = logs[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def slot(self, code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """The log10 probability of each byte in its context."""
        out = np.zeros(len(codes))
        left, slot = np.arange(len(codes)), self.slot(codes)
        unseen = []
        while len(left):
            key = self.keys[slot]
            hit = key == codes[left]
            out[left[hit]] = self.logs[slot[hit]]
            gone = key == _FREE
            unseen.append(left[gone])
            more = ~(hit | gone)
            left, slot = left[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        self._escape(codes, np.concatenate(unseen) if unseen else np.empty(0, np.int64), out)
        return out

    def _escape(self, codes: np.ndarray, left: np.ndarray, out: np.ndarray) -> None:
        less_n, less_d = np.zeros(len(left)), np.zeros(len(left))
        for k, (code, count, context, total, distinct, excluded) in zip(range(self.order, -1, -1), self.levels, strict=True):
            if not len(left):
                return
            if not len(context):
                continue
            own = codes[left] & self.mask(k)
            at = np.minimum(np.searchsorted(context, own >> np.uint64(8)), len(context) - 1)
            there = context[at] == own >> np.uint64(8)
            seen = np.zeros(len(left), bool)
            if len(code):
                where = np.minimum(np.searchsorted(code, own), len(code) - 1)
                seen = code[where] == own
            n, d = total[at] - less_n, distinct[at] - less_d
            whole = np.maximum(n + d, 1.0)
            if seen.any():
                out[left[seen]] += np.log10(count[where[seen]] / whole[seen])
            escaped = there & ~seen & (d > 0)  # if all are excluded the escape is certain
            out[left[escaped]] += np.log10(d[escaped] / whole[escaped])
            less_n, less_d = np.where(there, excluded[at], 0.0)[~seen], np.where(there, distinct[at], 0.0)[~seen]
            left = left[~seen]
        out[left] -= np.log10(_SYMBOLS - less_d)


def _block_of(code: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(code, 8).bitwiseAND(0xFFFF) * 40503, F.lit(blocks))


def tries(counts: DataFrame, order: int = ORDER, max_grams: int = MAX_GRAMS) -> Iterator[tuple[int, int, Trie]]:
    """(block, blocks, trie), one block after the other."""
    grams = counts.filter(F.col("kind") == _GRAM).select("key", "n")
    blocks = max(1, -(-grams.count() // max_grams))
    low = grams.groupBy(F.col("key").bitwiseAND(0xFFFF).alias("key")).agg(F.sum("n").alias("n")).toArrow()  # 65,536 rows at most
    pairs, pair_n = _merged([np.array(low["key"]).astype(np.uint64)], [np.array(low["n"])])
    for block in range(blocks):
        own = grams.filter(_block_of(F.col("key"), blocks) == block).toArrow()
        key, n = _merged([np.array(own["key"]).view(np.uint64)], [np.array(own["n"])])
        yield block, blocks, Trie(key, n, pairs, pair_n, order)


def score(
    docs: DataFrame,
    training: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    max_grams: int = MAX_GRAMS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score (of the words alone, each
    with probability (c + 0.5) / (N + 0.5 (V + 1))) and score (the model's), both log10."""
    spark = docs.sparkSession
    counts = count_corpus(training, text_col, order)
    words = counts.filter(F.col("kind") != _GRAM)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col("n"))), F.lit(0)).alias("ends")).first()
    tokens, kinds, ends = total["n"], total["v"], total["ends"]
    floor = tokens + 0.5 * (kinds + 1)

    def base(count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / floor)

    rare_below = max(2, -(-tokens // (1 << FREQUENT_BITS)))
    often = counts.filter((F.col("kind") == _WORD) & (F.col("n") >= rare_below)).select("key", "n").toArrow()
    often_key, often_n = _merged([np.array(often["key"]).view(np.uint64)], [np.array(often["n"])])
    frequent = spark.sparkContext.broadcast((often_key, often_n))

    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = more = None
    for block, blocks, trie in tries(counts, order, max_grams):
        model = spark.sparkContext.broadcast(trie)

        def run(
            batches: Iterator[pa.RecordBatch], model=model, block=block, blocks=blocks
        ) -> Iterator[pa.RecordBatch]:
            table, trie = blank_table(), model.value
            known, known_n = frequent.value
            for batch in batches:
                for at, part in text_slices(batch.column("text"), CODED_BYTES):
                    coded = Coded(part, order, table)
                    logs = np.zeros(len(coded.codes))
                    mine = slice(None)
                    if blocks > 1:
                        mine = np.flatnonzero((((coded.codes >> np.uint64(8)) & np.uint64(0xFFFF)) * np.uint64(40503)) % np.uint64(blocks) == block)
                    logs[mine] = trie.log10(coded.codes[mine])
                    sums = np.r_[0, np.cumsum(logs)]
                    columns = [*(batch.column(c).slice(at, len(part)) for c in ("row", "id")), pa.array(np.diff(sums[coded.starts]))]
                    if block == 0:
                        place = np.minimum(np.searchsorted(known, coded.words), max(len(known) - 1, 0))
                        sure = known[place] == coded.words if len(known) else np.zeros(len(coded.words), bool)
                        plain = np.zeros(len(coded.words))
                        plain[sure] = base(known_n[place[sure]])
                        a = coded.word_starts
                        some = np.r_[0, np.cumsum(sure)]
                        rare = np.r_[0, np.cumsum(~sure)][a].astype(np.int32)
                        columns += [
                            pa.array(np.diff(a) + 1),
                            pa.array(np.diff(some[a]) + int(ends > 0)),
                            pa.array(np.diff(np.r_[0, np.cumsum(plain)][a]) + base(np.array([ends]))[0]),
                            pa.ListArray.from_arrays(pa.array(rare), pa.array(coded.words[~sure].view(np.int64))),
                        ]
                    yield pa.record_batch(columns, names=["row", "id", "score", "n_tokens", "n_known", "base", "rare"][: len(columns)])

        schema = f"row long, id {id_type}, score double"
        if block == 0:
            scored = materialize(keyed.mapInArrow(run, f"{schema}, n_tokens long, n_known long, base double, rare array<long>"))
        else:
            part = materialize(keyed.mapInArrow(run, schema).select("row", F.col("score").alias("more")))
            more = part if more is None else more.unionByName(part)
        model.destroy()
    if more is not None:
        scored = scored.join(more.groupBy("row").agg(F.sum("more").alias("more")), "row").withColumn("score", F.col("score") + F.col("more"))

    wanted = scored.select("row", F.explode("rare").alias("key"))
    rare = counts.filter((F.col("kind") == _WORD) & (F.col("n") < rare_below)).select("key", "n")
    count = F.coalesce("n", F.lit(0))
    per_row = wanted.join(rare, "key", "left").groupBy("row").agg(
        F.sum(F.log10((count + 0.5) / F.lit(floor))).alias("rare_base"), F.count("n").alias("rare_known")
    )
    return scored.join(per_row, "row", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
