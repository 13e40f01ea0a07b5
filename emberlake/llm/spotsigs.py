"""Document fingerprints by spot signatures.

Where a common word (an anchor) stands, it and the next ``chain`` content words, ``distance`` apart, form a
signature. A text's fingerprint is the multiset of its signatures, 32-bit hashes; likeness is the Jaccard
similarity of multisets. Words are runs of letters and digits, lower case. A text without an anchor takes
every word for one, and a text without words is one signature of itself.

``fingerprint_neighbours`` compares each text with an edited version and with the next document.
``similar_pairs`` finds all pairs over a threshold: fingerprints are partitioned by their length, so that
only the same or the next partition can hold a partner, and met by an inverted index on their rarest
signatures; pairs that lengths rule out are pruned before the exact comparison.

Scale: for neighbours, documents go to ranges of ids, at most ``MAX_RANGES``, whose bounds come from Spark's range
partitioning of the ids alone, whatever their type. The first document of a range is copied to the range above it,
and each range is a task of its own, a stream that holds two documents at a time. Texts are shuffled once. For pairs, equal fingerprints are one class, and no group is gathered.

Defined results: null text is empty; the empty text has an empty fingerprint and likeness 1 to itself, 0 to
others; rows with equal ids follow each other by text; null ids come last; a lone document is its own next;
an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import hash_words, letter_table, materialize, mix64, text_slices

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "the of and to in a is that it for on with as was be by this are or at from "
    "de la le les et des en un une du est que qui dans pour pas sur au "
    "der die und das den von zu mit sich auf ist im dem nicht ein eine als "
    "el los las y por con para una no se lo su es"
).split()
CHAIN, DISTANCE = 2, 1
SIMILAR = 0.8
#: Rows of an id range, while there are at most so many ranges; their bounds reach the driver.
RANGE_ROWS, MAX_RANGES = 5000, 16_384


class Signer:
    """The sorted 32-bit signatures of texts."""

    def __init__(self, anchors: list[str], chain: int, distance: int):
        self.table = letter_table()
        self.anchors = np.unique(hash_words(pa.array([" ".join(anchors)], pa.large_string()), self.table)[0])
        self.chain, self.distance = chain, distance

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        for at, part in text_slices(pa.array(texts, pa.large_string())):
            words, starts = hash_words(pc.utf8_lower(part), self.table)
            common = np.isin(words, self.anchors)
            for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                if a < b:
                    yield self._signatures(words[a:b], common[a:b])
                elif texts[at + i]:
                    digest = hashlib.blake2b(texts[at + i].encode(), digest_size=4).digest()
                    yield np.frombuffer(digest, "<u4")
                else:
                    yield np.empty(0, "<u4")

    def _signatures(self, words: np.ndarray, common: np.ndarray) -> np.ndarray:
        content = np.flatnonzero(~common)
        spots = np.flatnonzero(common)
        if not len(spots) or not len(content):
            spots = content = np.arange(len(words))
        value = words[spots]
        after = np.searchsorted(content, spots, "right")
        for k in range(self.chain):  # a chain that the text's end cuts is shorter
            at = after + k * self.distance
            there = at < len(content)
            follow = np.zeros(len(spots), np.uint64)
            follow[there] = words[content[at[there]]]
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + follow)
        return np.sort((value >> np.uint64(32)).astype("<u4"))


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two sorted multisets; 1 for two empty ones."""
    if not len(x) and not len(y):
        return 1.0
    values, where = np.unique(np.concatenate((x, y)), return_inverse=True)
    left = np.bincount(where[: len(x)], minlength=len(values))
    right = np.bincount(where[len(x) :], minlength=len(values))
    return float(np.minimum(left, right).sum() / np.maximum(left, right).sum())


def encoded(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.tobytes()).decode()


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _range_of(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are less than ``value``, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < value))

    run = below(F.array(*(F.lit(r[-1]) for r in runs)))  # whole runs below
    inner = F.element_at(F.array(*(F.array(*map(F.lit, r)) for r in runs)), F.least(run + 1, F.lit(len(runs))))
    return F.when(value.isNull(), 0).when(run >= len(runs), len(bounds)).otherwise(run * step + below(inner))


def fingerprint_neighbours(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    anchors: list[str] | None = None,
    chain: int = CHAIN,
    distance: int = DISTANCE,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_signatures. The next document is that of the next lower id, after the last the first."""
    anchors = ANCHORS if anchors is None else anchors
    ids = docs.select(F.col(id_col).alias("id"))
    ranges = min(max(1, -(-ids.count() // range_rows)), MAX_RANGES)
    parts = ids.repartitionByRange(ranges, "id").groupBy(F.spark_partition_id()).agg(F.max("id").alias("top"))
    # A range ends with the greatest id of its part; null ids are with the least.
    tops = sorted(r["top"] for r in parts.collect() if r["top"] is not None) or [None]
    bounds = tops[:-1]
    kind = docs.schema[id_col].dataType
    id_type = kind.simpleString()
    top = F.array(*(F.lit(t).cast(kind) for t in tops))
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    keyed = keyed.withColumn("range", _range_of(F.col("id"), bounds).cast("int"))
    own = F.struct("range", F.lit(False).alias("copy"))
    copied = F.struct(F.pmod(F.col("range") + 1, F.lit(len(tops))).alias("range"), F.lit(True).alias("copy"))
    first = F.col("id").eqNullSafe(F.element_at(top, F.col("range") + 1))
    dealt = keyed.select("id", "text", F.explode(F.when(first, F.array(own, copied)).otherwise(F.array(own))).alias("to"))
    # The first document of a range goes also to the range above it, that of the highest to the lowest.
    dealt = dealt.select("id", "text", "to.range", "to.copy").repartitionById(len(tops), "range")
    dealt = dealt.sortWithinPartitions("range", "copy", F.col("id").desc_nulls_last(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(anchors, chain, distance)
        last = None  # the row whose next one is awaited
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                mine = list(zip(part.column("id").to_pylist(), texts, part.column("range").to_pylist(), part.column("copy").to_pylist(), signer(texts), strict=True))
                pairs = []
                for row in mine:
                    if last is not None and last[2] == row[2] and not last[3]:
                        pairs.append((last, row))
                    last = row
                changed = [edited(a[1], b[1]) for a, b in pairs]
                for (a, b), new, signed in zip(pairs, changed, signer(changed), strict=True):
                    cells = (
                        a[0], len(a[1]), hashlib.sha256(new.encode()).hexdigest(), encoded(a[4]), encoded(signed),
                        likeness(a[4], signed), likeness(a[4], b[4]), len(a[4]),
                    )
                    for column, cell in zip(out, cells, strict=True):
                        column.append(cell)
            text, number, real = pa.string(), pa.int64(), pa.float64()
            kinds = (batch.schema.field("id").type, number, text, text, text, real, real, number)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_signatures"]
    schema = f"`{id_col}` {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
    return dealt.mapInArrow(run, f"{schema}, near_edited double, near_next double, n_signatures long")


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    anchors: list[str] | None = None,
    chain: int = CHAIN,
    distance: int = DISTANCE,
) -> DataFrame:
    """(id, signatures): the distinct signatures of each row, sorted."""
    anchors = ANCHORS if anchors is None else anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(anchors, chain, distance)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            signed = [np.unique(s).astype(np.int64) for s in signer(texts)]
            yield pa.record_batch([batch.column(0), pa.array(signed, pa.list_(pa.int64()))], names=["id", "signatures"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {id_type}, signatures array<long>")


def similar_pairs(signed: DataFrame, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """From (id, signatures) the classes (id, class), of equal sets by their least id, and the pairs of
    classes (a, b, similarity) with Jaccard similarity of at least ``least``. Empty sets have no partner."""
    stored = materialize(signed.filter(F.size("signatures") > 0).withColumn("set", F.sha2(F.array_join("signatures", ","), 256)))
    reps = materialize(stored.groupBy("set").agg(F.min("id").alias("class"), F.any_value("signatures").alias("signatures")))
    classes = stored.join(reps.select("set", "class"), "set").select("id", "class")
    size = F.size("signatures")
    # A partner's length is between least * length and length / least: the same or the next partition.
    each = reps.filter("class IS NOT NULL").select("class", "signatures", size.alias("n"), F.floor(F.log(size.cast("double")) / F.lit(-np.log(least))).alias("part"))
    spots = each.select("class", "n", "part", F.explode("signatures").alias("signature"))
    often = spots.groupBy("signature").agg(F.count("*").alias("often"))
    ranked = spots.join(often, "signature").groupBy("class", "n", "part").agg(F.array_sort(F.collect_list(F.struct("often", "signature"))).alias("ranked"))
    # Two sets that are similar share one of their n - ceil(least * n) + 1 rarest signatures.
    prefix = F.slice("ranked", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))
    index = materialize(ranked.select("class", "n", "part", F.explode(F.transform(prefix, lambda r: r["signature"])).alias("signature")))
    left = index.select("signature", F.col("class").alias("a"), F.col("n").alias("na"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = index.select("signature", "part", F.col("class").alias("b"), F.col("n").alias("nb"))
    met = left.join(right, ["signature", "part"]).filter(
        (F.col("na") >= least * F.col("nb") - 1e-9) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    )
    met = met.select("a", "b").distinct()
    sets = each.select("class", "signatures")
    full = met.join(sets.select(F.col("class").alias("a"), F.col("signatures").alias("x")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("signatures").alias("y")), "b"
    )
    both = F.size(F.array_intersect("x", "y"))
    similar = full.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (both / (F.size("x") + F.size("y") - both)).alias("similarity"))
    return classes, similar.filter(F.col("similarity") >= least - 1e-12)
