"""Near-duplicate detection by fast similarity sketching, banding and exact verification.

A document is the set of its word shingles. Its sketch has ``coordinates`` bins filled in rounds:
in round i < coordinates every shingle is thrown into a hashed bin, later rounds throw all shingles
into one given bin, so that every bin fills; a bin keeps its least (round, hash). Two sketches agree
in a bin with the Jaccard similarity as probability. Documents that agree in all rows of a band are
candidates, and a link is made only after the full shingle sets have been compared.

Scale: exact copies (equal sets) become one class before banding. In a bucket every member is first
compared with the bucket's least document only, which connects most groups. A bucket that still holds several
components is cut into blocks of bounded size, large components into blocks of their own, and each pair of blocks
that may hold a link between components is one small group, in which all intersections are counted at once by a matrix
product; only links that join components come out, so no link between components is lost and no pairs are emitted. A
component's own blocks never meet, so what pivots connect costs nothing however large it is. Nothing is collected but counts. Texts are read again for candidates only, whose ids are broadcast if they are counted to be at
most ``BROADCAST_IDS``, and joined by a shuffle beyond that. Classes of equal sets that hold more than 1 / ``HOT_CLASSES``
of all rows, at most that many, are broadcast to their rows; the rows of the others are joined by a shuffle.

Defined results: null or blank text has an empty set and is linked with nothing; repeated rows and
rows that share a document id are one document; an empty table gives an empty result; other columns
are ignored. A null id is kept and stands alone or takes the least id of its component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import (
    blank_table,
    hash_words,
    materialize,
    mix64,
    shingle_hashes,
    text_slices,
    tidy,
)

#: Chance of a pair at the threshold to meet in no band: (1 - 0.8^4)^32, about 5e-8.
BANDS, ROWS = 32, 4
#: A sketch agreement so far below the threshold (six standard deviations) rules a pair out.
DEVIATIONS = 6.0
#: A block of a bucket: documents, and bytes of shingle sets, at most (one document may be larger).
BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 24
#: Classes of equal sets that are broadcast at most.
HOT_CLASSES = 1000
#: Ids of up to 40 bytes each in an executor's memory.
BROADCAST_IDS = 1_000_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 48) - 1)


def sketch(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes."""
    seeds = mix64(np.arange(1, 2 * coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.full(coordinates, _EMPTY)
    at = 0
    # Few shingles need many rounds: several rounds are thrown together.
    together = max(1, 6 * coordinates // len(shingles))
    while at < coordinates:
        to = min(coordinates, at + together)
        thrown = mix64(shingles[None, :] ^ seeds[at:to, None])
        rounds = np.arange(at, to, dtype=np.uint64)[:, None] << np.uint64(48)
        bins = (thrown >> np.uint64(40)) % np.uint64(coordinates)
        np.minimum.at(out, bins.astype(np.int64).ravel(), (rounds | (mix64(thrown) & _LOW)).ravel())
        if not (out == _EMPTY).any():
            return out
        at = to
    for j in np.flatnonzero(out == _EMPTY):  # round coordinates + j goes into bin j alone
        least = (mix64(mix64(shingles ^ seeds[coordinates + j])) & _LOW).min()
        out[j] = (np.uint64(coordinates + j) << np.uint64(48)) | least
    return out


def _band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + values.reshape(bands, rows)[:, i])
    return key.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """One row per input row: id, n_shingles, set_id (digest of the set), band keys, low sketch bytes."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_shingles long, set_id binary, bands array<long>, low binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = blank_table()
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                hashes, starts = hash_words(texts, table)
                n, sets, keys, low = [], [], [], []
                for a, b in zip(starts[:-1], starts[1:], strict=True):
                    unique = np.unique(shingle_hashes(hashes[a:b], shingle))
                    n.append(len(unique))
                    sets.append(hashlib.blake2b(unique.tobytes(), digest_size=16).digest())
                    if len(unique):
                        values = sketch(unique, bands * rows)
                        keys.append(_band_keys(values, bands, rows))
                        low.append(values.astype(np.uint8).tobytes())
                    else:
                        keys.append(np.empty(0, np.int64))
                        low.append(b"")
                yield pa.record_batch(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array(n, pa.int64()),
                        pa.array(sets, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(low, pa.binary()),
                    ],
                    names=["id", "n_shingles", "set_id", "bands", "low"],
                )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)


def _alike(pairs: DataFrame, low: DataFrame, least: float) -> DataFrame:
    """The pairs whose sketches agree in at least the share ``least`` of their low bytes."""
    joined = pairs.join(low.select(F.col("id").alias("a"), F.col("low").alias("low_a")), "a").join(
        low.select(F.col("id").alias("b"), F.col("low").alias("low_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("low_a").to_pylist(), batch.column("low_b").to_pylist()
            keep = [
                np.count_nonzero(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) >= least * len(x)
                for x, y in zip(left, right, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(tidy(run), joined.select("a", "b").schema)


def _texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, text) of the ids."""
    ids = materialize(ids.distinct())
    return texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id")


def _shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    table = blank_table()
    for _, part in text_slices(column):
        hashes, starts = hash_words(part, table)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield np.unique(shingle_hashes(hashes[a:b], shingle))


def _confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    wanted = materialize(_texts_of(ids, texts))
    joined = pairs.join(wanted.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").join(
        wanted.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            left, right = (_shingle_sets(batch.column(c), shingle) for c in ("text_a", "text_b"))
            for x, y in zip(left, right, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(tidy(run), joined.select("a", "b").schema)


def joining_links(sets: list[np.ndarray], labels: list, blocks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Index pairs of similar sets that join different labels, as few as connect them. If the sets are of two
    blocks, only pairs of one from each are looked at."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.float64)
    row = np.repeat(np.arange(n), size.astype(np.int64))
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(often[column] > 1)  # others are in no intersection
    order = shared[np.argsort(column[shared], kind="stable")]
    row, column = row[order], column[order]
    column = np.cumsum(np.r_[0, column[1:] != column[:-1]]) if len(column) else column
    both = np.zeros((n, n), np.float32)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 4097, 4096))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        dense = np.zeros((n, 4096), np.float32)
        dense[row[a:b], column[a:b] - 4096 * k] = 1
        both += dense @ dense.T
    alike = 100 * both.astype(np.float64) >= percent * (size[:, None] + size[None, :] - both)
    if len(set(blocks.tolist())) > 1:
        alike &= blocks[:, None] != blocks[None, :]
    parent = {label: label for label in labels}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i in range(n):
        for j in np.flatnonzero(alike[i, :i]).tolist():
            x, y = root(labels[i]), root(labels[j])
            if x != y:
                parent[x] = y
                links.append((i, j))
    return links


def _blocks(members: DataFrame) -> DataFrame:
    """(key, rep, label, block, other): the block of each member of (key, rep, label, bytes), once for each
    block of its bucket that it is compared with. Labels with many members have blocks of their own, which meet
    those of other labels; the rest are pooled, all members of a label in one block, and meet all."""
    rows, size = BLOCK_ROWS, BLOCK_BYTES
    counted = members.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    large = (F.col("n") >= rows // 2) | (F.col("bytes") >= size // 2)
    parts = F.greatest(F.ceil(F.col("n") / rows), F.ceil(F.col("bytes") / size)).cast("int")
    counted = materialize(counted.select("key", "label", "n", "bytes", F.when(large, parts).alias("parts")))
    pools = F.greatest(
        F.ceil(F.sum(F.when(~large, F.col("n"))) / (rows // 2)), F.ceil(F.sum(F.when(~large, F.col("bytes"))) / (size // 2)), F.lit(0)
    ).cast("int")
    # At most two blocks for each ``rows`` / 2 members of a bucket.
    own = F.transform(F.sequence(F.lit(1), "parts"), lambda i: F.named_struct(F.lit("owner"), F.col("label"), F.lit("part"), (i - 1).cast("int")))
    owned = F.flatten(F.array_sort(F.collect_list(F.when(F.col("parts").isNotNull(), own))))
    layout = counted.groupBy("key").agg(owned.alias("owned"), pools.alias("pools"))
    nobody = F.lit(None).cast(members.schema["label"].dataType)
    pooled = F.transform(F.sequence(F.lit(1), F.col("pools")), lambda i: F.named_struct(F.lit("owner"), nobody, F.lit("part"), (i - 1).cast("int")))
    pooled = F.when(F.col("pools") > 0, pooled).otherwise(F.slice(pooled, 1, 0))
    layout = layout.select("key", F.concat("owned", pooled).alias("blocks"), "pools")
    sized = members.join(counted.select("key", "label", "parts"), ["key", "label"]).join(layout, "key")
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("rep"), F.col("parts"))).otherwise(F.pmod(F.xxhash64("label"), F.greatest("pools", F.lit(1))))
    owner = F.when(F.col("parts").isNotNull(), F.col("label"))
    block = F.array_position("blocks", F.named_struct(F.lit("owner"), owner, F.lit("part"), part.cast("int"))).cast("int")
    each = sized.select("key", "rep", "label", owner.alias("owner"), block.alias("block"), F.posexplode("blocks").alias("at", "with"))
    # Two blocks of one large component hold no link that joins components.
    useless = F.col("owner").isNotNull() & F.col("owner").eqNullSafe(F.col("with.owner"))
    return each.filter(~useless).select("key", "rep", "label", "block", (F.col("at") + 1).alias("other"))


def _block_links(mixed: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b): links that join components within the mixed buckets, found block by block."""
    kind = mixed.schema["rep"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in _shingle_sets(batch.column(1), shingle)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["rep", "set"])

    ids = mixed.select(F.col("rep").alias("id"))
    sets = materialize(_texts_of(ids, texts).select("id", "text").mapInArrow(tidy(signed), f"rep {kind}, set binary"))
    members = mixed.select("key", "rep", "label").join(sets.withColumn("bytes", F.length("set").cast("long")), "rep")
    blocked = _blocks(members.select("key", "rep", "label", "bytes"))
    units = blocked.join(sets, "rep")
    units = units.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "label", "set")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        reps, labels = rows["rep"].tolist(), rows["label"].tolist()
        found = joining_links([np.frombuffer(s, np.uint64) for s in rows["set"]], labels, rows["block"].to_numpy(), percent)
        return pd.DataFrame({"a": [reps[i] for i, _ in found], "b": [reps[j] for _, j in found]}, columns=["a", "b"])

    return units.groupBy("key", "low", "high").applyInPandas(run, f"a {kind}, b {kind}")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table: (id, component), the least id of each, for every id that
    has an edge. Large-star and small-star steps alternate until the edges stay the same; a hub's edges
    are joined and aggregated, never gathered."""
    edges = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        state = seen
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        edges = materialize(small.select("e.u", "e.v").filter("u <> v").distinct())


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, label): members of the buckets that hold several components, with their own."""
    labelled = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("label")
    )
    mixed = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    return materialize(labelled.join(mixed.select("key"), "key"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: id, n_shingles, set_id (its class of equal sets), component_id (least id
    reachable over links of ``percent`` % similarity), kept (it is its component's least)."""
    found = materialize(sketches(docs, id_col, text_col, shingle, bands, rows))
    some = found.filter("n_shingles > 0")
    classes = some.groupBy("set_id").agg(
        F.min("id").alias("rep"), F.min_by(F.struct("bands", "low"), "id").alias("sketch"), F.count("*").alias("n")
    )
    reps = materialize(classes.filter("rep IS NOT NULL").select("set_id", "rep", "sketch.bands", "sketch.low", "n"))
    low = reps.select(F.col("rep").alias("id"), "low")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    slots = reps.select("rep", F.explode("bands").alias("key"))
    buckets = slots.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    members = materialize(slots.join(buckets.select("key", "pivot"), "key"))

    same = percent / 100
    least = same - DEVIATIONS * (same * (1 - same) / (bands * rows)) ** 0.5

    pairs = members.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = materialize(_confirm(materialize(_alike(pairs, low, least)), texts, shingle, percent))
    labels = components(links)
    mixed = _mixed(members, labels)
    if not mixed.isEmpty():
        more = materialize(_block_links(mixed, texts, shingle, percent))
        labels = components(more.unionByName(labels.select(F.col("id").alias("a"), F.col("component").alias("b"))))

    named = reps.select("set_id", F.col("rep").alias("id"), "n").join(labels, "id", "left")
    named = materialize(named.groupBy("set_id").agg(F.min(F.coalesce("component", "id")).alias("component"), F.max("n").alias("n")))
    often = some.count() / HOT_CLASSES
    hot = F.broadcast(named.filter(F.col("n") > often).select("set_id", "component"))
    cold = named.filter(F.col("n") <= often).select("set_id", "component")
    plain = found.select("id", "n_shingles", "set_id")
    out = plain.join(hot, "set_id").unionByName(plain.join(hot, "set_id", "left_anti").join(cold, "set_id", "left"))
    alone = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        "set_id",
        F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(alone).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
