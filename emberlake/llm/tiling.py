"""Benchmark decontamination by greedy string tiling.

A document is compared with a benchmark item when they share a seed, a run of ``match`` tokens, or all tokens of a
shorter item. Tiles are then the longest non-overlapping common runs, marked longest first: hashes of windows (running
Karp-Rabin) find runs of a search length, which falls until it reaches that of the seeds. An item is contaminated
by a document whose tiles cover at least the share ``threshold`` of the item's tokens, in any order, so
reordered passages count.

Tokens are runs of letters and digits, lower case; other characters separate them. Scripts that are written without
blanks (Chinese, Japanese, Thai, Lao, Khmer, Burmese) have a token for each character.

Scale: the benchmark's seeds set bits in a map of fixed size (``bits``), which is all that is broadcast.
Documents are read once and keep only windows whose bit is set. Of an item, the commonest seeds are set aside as long
as they cover less than the threshold between them: a document that reaches the threshold holds one of the others. So a
phrase that many documents and many items share pairs none of them by itself, however many they are. Pairs that a
remaining seed brings about are joined with all seeds of the two; texts only for pairs that could reach the threshold.

Defined results: null and blank texts and items match nothing; repeated
rows are judged alike; repeated items count once each under their id; rows with a null id are kept and
judged as one document (null with null); an empty table gives an empty result, an empty benchmark leaves
all documents clean; of items of equal coverage the least id is named.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import (
    BASE,
    hash_words,
    inverse,
    letter_table,
    materialize,
    powers,
    shingle_hashes,
    text_slices,
    tidy,
)

MATCH = 5
THRESHOLD = 0.5
#: Bits of the seed map, whatever the benchmark's size: 4 MB.
SEED_BITS = 25

Tile = tuple[int, int, int]
#: Common windows of a pair from which on runs are found row by row.
_DENSE = 1 << 20
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
#: Their punctuation, which ends no ASCII byte: fixed values.
_UNSPACED_STOPS = r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{30FB}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF5B}-\x{FF65}]"


def _spaced(texts: pa.Array) -> pa.Array:
    """Texts with blanks around characters of unspaced scripts; their punctuation becomes blanks."""
    data = texts.buffers()[2]
    if data is None or not (np.frombuffer(data, np.uint8) >= 0xE0).any():  # such characters have three bytes
        return texts
    return pc.replace_substring_regex(pc.replace_substring_regex(texts, _UNSPACED_STOPS, " "), _UNSPACED, r" \1 ")


def _token_hashes(texts: pa.Array, table: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The row and the hashes of the tokens of each row."""
    for at, part in text_slices(texts):
        hashes, starts = hash_words(_spaced(pc.utf8_lower(part)), table)
        for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            yield at + i, hashes[a:b]


def greedy_tiles(item: np.ndarray, text: np.ndarray, match: int = MATCH) -> list[Tile]:
    """(item start, text start, length) of the tiles, longest first."""
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    tiles: list[Tile] = []
    length = min(len(item), len(text))
    while length >= match:
        # Windows of ``length`` tokens that are wholly free, met by hash and then compared.
        found = _runs(item, text, free_item, free_text, length)
        longest = max((n for _, _, n in found), default=0)
        if longest > 2 * length:
            length = longest
            continue
        for a, b, n in sorted(found, key=lambda t: (-t[2], t[0], t[1])):
            if free_item[a : a + n].all() and free_text[b : b + n].all():
                free_item[a : a + n] = free_text[b : b + n] = False
                tiles.append((a, b, n))
        if not found or not _runs(item, text, free_item, free_text, length):
            length = max(match, length // 2) if length > match else 0
    return tiles


def _runs(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, length: int) -> list[Tile]:
    """Common runs of at least ``length`` free tokens, extended as far as they go."""

    def windows(tokens: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(tokens) < length:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        room = np.convolve(free, np.ones(length, np.int64), "valid") == length
        at = np.flatnonzero(room)
        return _rolling(tokens, length)[at], at

    left, left_at = windows(item, free_item)
    right, right_at = windows(text, free_text)
    wanted = np.isin(right, left)
    right, right_at = right[wanted], right_at[wanted]
    order = np.argsort(left, kind="stable")
    left, left_at = left[order], left_at[order]
    low, high = np.searchsorted(left, right, "left"), np.searchsorted(left, right, "right")
    often = high - low
    if often.sum() > _DENSE:
        return _runs_by_row(item, text, free_item, free_text, length)
    # Neighbours on a diagonal are one run.
    b = np.repeat(right_at, often)
    a = left_at[np.repeat(low, often) + np.arange(len(b)) - np.repeat(np.cumsum(often) - often, often)]
    order = np.lexsort((a, b - a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.r_[True, (np.diff(a) != 1) | (np.diff(b) != 1)]) if len(a) else np.empty(0, np.int64)
    size = np.diff(np.r_[first, len(a)]) + length - 1
    out = []
    for i, j, n in zip(a[first].tolist(), b[first].tolist(), size.tolist(), strict=True):
        same = item[i : i + n] == text[j : j + n]
        n = n if same.all() else int(same.argmin())  # hashes may collide
        if n >= length:
            out.append((i, j, n))
    return out


def _runs_by_row(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, length: int) -> list[Tile]:
    """The same runs where tokens repeat so much that the windows' pairs are many: how far each pair of tokens
    goes on is known from the item's next token, so that only two rows are held."""
    out = []
    goes = np.zeros(len(text) + 1, np.int32)  # row a + 1, then row a
    for a in range(len(item) - 1, -2, -1):
        same = (text == item[a]) & free_text if a >= 0 and free_item[a] else np.zeros(len(text), bool)
        # Runs of the row after this one begin where this row's token does not lead to them.
        starts = goes[:-1] >= length
        starts[1:] &= ~same[:-1]
        out += [(a + 1, b, int(goes[b])) for b in np.flatnonzero(starts).tolist()]
        now = np.zeros(len(text) + 1, np.int32)
        now[:-1][same] = goes[1:][same] + 1
        goes = now
    return out


def _rolling(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows, by prefix sums of a polynomial modulo 2^64."""
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens * powers(BASE, len(tokens)), out=sums[1:])
    return (sums[length:] - sums[:-length]) * powers(inverse(BASE), len(tokens) - length + 1)


def seeds(
    table: DataFrame,
    id_col: str,
    text_col: str,
    match: int,
    seed_map: bytes | None = None,
    sizes: Sequence[int] = (),
) -> DataFrame:
    """(id, length, size, seed, at): each run of ``match`` tokens, or all tokens of a shorter text; with a seed
    map the runs of ``sizes`` tokens that are in it, once per row."""
    id_type = table.schema[id_col].dataType.simpleString()
    shared = table.sparkSession.sparkContext.broadcast(seed_map)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        bits = None if shared.value is None else np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            rows, lengths, own_sizes, found, places = [], [], [], [], []
            for i, tokens in _token_hashes(batch.column(1), letters):
                for size in sizes if bits is not None else [min(match, len(tokens))]:
                    if not 0 < size <= len(tokens):
                        continue
                    runs = shingle_hashes(tokens, size)
                    if bits is None:
                        at = np.arange(len(runs))
                    else:
                        slot = runs >> np.uint64(64 - SEED_BITS)
                        at = np.flatnonzero((bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
                        at = at[np.unique(runs[at], return_index=True)[1]]
                    if len(at):
                        rows.append(np.full(len(at), i))
                        lengths.append(np.full(len(at), len(tokens)))
                        own_sizes.append(np.full(len(at), size))
                        found.append(runs[at].view(np.int64))
                        places.append(at)
            if rows:
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(np.concatenate(rows))),
                        pa.array(np.concatenate(lengths).astype(np.int32)),
                        pa.array(np.concatenate(own_sizes).astype(np.int32)),
                        pa.array(np.concatenate(found)),
                        pa.array(np.concatenate(places).astype(np.int32)),
                    ],
                    names=["id", "length", "size", "seed", "at"],
                )

    schema = f"id {id_type}, length int, size int, seed long, at int"
    return table.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)


def set_aside(costs: np.ndarray, seeds_: np.ndarray, places: np.ndarray, size: int, budget: float) -> np.ndarray:
    """Which of an item's seeds (one entry a place) need not be looked for: the commonest ones, while what they
    cover between them is below ``budget`` tokens. Tiles that cover as much hold a window of another seed."""
    covered = np.zeros(int(places.max()) + size if len(places) else 0, bool)
    aside = np.zeros(len(seeds_), bool)
    by_seed = np.lexsort((places, seeds_, -costs))
    cuts = np.flatnonzero(np.r_[True, np.diff(seeds_[by_seed]) != 0, True])
    n = 0
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = by_seed[a:b]
        window = np.unique((places[own, None] + np.arange(size)).ravel())
        more = int((~covered[window]).sum())
        if n + more < budget:
            n += more
            covered[window] = True
            aside[own] = True
    return aside


def candidate_pairs(hits: DataFrame, item_seeds: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, item): documents and items that share a seed which is not set aside."""
    often = hits.groupBy("seed").agg(F.count("*").alias("docs"))
    held = item_seeds.groupBy("seed").agg(F.count("*").alias("items"))
    cost = F.col("docs") * F.col("items")
    # A seed that no document holds needs no looking for.
    rated = item_seeds.join(often, "seed").join(held, "seed").select("id", "length", "size", "seed", "at", cost.cast("double").alias("cost"))
    kind = item_seeds.schema["id"].dataType.simpleString()

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        # Texts of one id are taken together; what holds for the shortest holds for each.
        aside = set_aside(
            rows["cost"].to_numpy(),
            rows["seed"].to_numpy(),
            rows["at"].to_numpy(np.int64),
            int(rows["size"].max()),
            threshold * rows["length"].min(),
        )
        return rows.loc[~aside, ["id", "seed"]].drop_duplicates().rename(columns={"id": "item"})

    wanted = rated.groupBy("id").applyInPandas(pick, f"item {kind}, seed long")
    return hits.join(wanted, "seed").select("id", "item").distinct()


def seed_map(item_seeds: DataFrame) -> bytes:
    """The map of fixed size: bit (seed's highest bits) is set for each seed of the benchmark. The bytes
    that have a bit are made by an aggregation; at most 2^SEED_BITS / 8 of them reach the driver."""
    slot = F.shiftrightunsigned("seed", 64 - SEED_BITS)
    bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (slot % 8 + 1).cast("int"))
    cells = item_seeds.select(F.shiftright(slot, 3).alias("byte"), bit.alias("bit"))
    out = np.zeros(1 << (SEED_BITS - 3), np.uint8)
    for row in cells.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        out[row["byte"]] = row["bits"]
    return out.tobytes()


def tile_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    match: int = MATCH,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, item, coverage, tiles): the pairs whose tiles reach the threshold, with the tiles' places."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("item_text"))
    item_seeds = materialize(seeds(items, "item", "item_text", match))
    sizes = sorted(r["size"] for r in item_seeds.select("size").distinct().collect())  # at most ``match``
    hits = materialize(seeds(docs, id_col, text_col, match, seed_map(item_seeds), sizes).select("id", "seed"))
    near = materialize(candidate_pairs(hits, item_seeds, threshold))
    theirs = near.alias("n").join(hits.alias("h"), F.col("n.id").eqNullSafe(F.col("h.id"))).select("n.id", "n.item", "h.seed")
    own = item_seeds.select(F.col("id").alias("own"), "length", "size", "seed", "at")
    joined = theirs.join(own, (theirs["seed"] == own["seed"]) & theirs["item"].eqNullSafe(own["own"]))
    # Tokens of the item in shared seeds: no tiles cover more. An item's places are bounded by its length.
    within = F.sequence("at", F.col("at") + F.col("size") - 1)
    covered = joined.groupBy("id", "item").agg(
        F.min("length").alias("length"), F.size(F.array_distinct(F.flatten(F.collect_set(within)))).alias("most")
    )
    pairs = materialize(covered.filter(F.col("most") >= threshold * F.col("length")).select("id", "item"))
    same = pairs["id"].eqNullSafe(F.col("d.doc"))
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).alias("d")
    joined = pairs.join(texts, same).join(items, pairs["item"].eqNullSafe(items["item"])).select("id", pairs["item"], "text", "item_text")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            rows, coverage, tiles = [], [], []
            left = _token_hashes(batch.column("item_text"), letters)
            right = _token_hashes(batch.column("text"), letters)
            for (i, item), (_, text) in zip(left, right, strict=True):
                found = greedy_tiles(item, text, min(match, len(item))) if len(item) else []
                share = sum(n for _, _, n in found) / len(item) if len(item) else 0.0
                if found and share >= threshold:
                    rows.append(i)
                    coverage.append(share)
                    tiles.append([{"item_start": a, "start": b, "length": n} for a, b, n in found])
            tile = pa.list_(pa.struct([("item_start", pa.int32()), ("start", pa.int32()), ("length", pa.int32())]))
            ids = batch.select(["id", "item"]).take(pa.array(rows, pa.int64()))
            yield pa.record_batch(
                [*ids.columns, pa.array(coverage, pa.float64()), pa.array(tiles, tile)], names=["id", "item", "coverage", "tiles"]
            )

    return joined.mapInArrow(
        tidy(run),
        f"id {kinds['id']}, item {kinds['item']}, coverage double, tiles array<struct<item_start:int,start:int,length:int>>",
    )


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, contaminated, n_items, item_id (of the greatest coverage, the least id
    among equals), coverage and tiles of that item; for clean documents 0, null, 0.0 and null."""
    found = tile_pairs(docs, benchmark, id_col, **options)
    best = found.groupBy("id").agg(
        F.count_distinct("item").alias("n_items"),
        F.min(F.struct((-F.col("coverage")).alias("less"), "item", "tiles")).alias("best"),
    )
    best = materialize(best)
    ids = docs.select(F.col(id_col).alias("doc"))
    out = ids.join(best, ids["doc"].eqNullSafe(best["id"]), "left")
    return out.select(
        F.col("doc").alias(id_col),
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.col("best.item").alias("item_id"),
        F.coalesce(-F.col("best.less"), F.lit(0.0)).alias("coverage"),
        F.col("best.tiles").alias("tiles"),
    )
