"""Language identification by Bayesian evidence fusion.

The languages are all that rows declare with at least ``min_trigrams`` letter trigrams of text. A naive Bayes
model of byte trigrams, trained on the rows by their declared language, gives each text's likelihoods. From their
posteriors, summed by groups, come the reliability of declarations P(declared | language), of address
suffixes P(suffix | language), and host priors, smoothed by the host's site and that by the whole
corpus. A row's posterior is the product of all four. ``und``, a language in which all trigrams are alike,
takes part with a small prior, so that text in no known language is rejected. A declared language with less
text than that has no model; in its rows ``und`` stands for it, without the small prior, and they are accepted
as that language unless a modelled one is accepted for them.

Scale: the model is languages x 2^16 numbers. ``block`` languages are broadcast at a time (64 MB); more
languages take more passes over texts that are written once with a row number. A row keeps the languages within
``SPAN`` of its likeliest one: the others cannot change a posterior by a double's precision. Counts and
evidence are aggregated in each task first; trigram counts, hosts, suffixes and declarations are tables.
Only the languages' names and one number each are collected besides the model's blocks.

Defined results: null text and text without letters is ``und``, posterior 0, and rejected; a null, empty or
``und`` declaration and a null or unknown suffix or host add no evidence; repeated rows are judged alike; a null
id stays null; an empty table gives an empty result; where no language has a model, declared rows with letters
are accepted as what they declare, posterior 1, and all others are ``und``, posterior 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import ascii_lower, materialize, mix64, text_slices, tidy

UNKNOWN = "und"
BINS_BITS = 16
#: Letter trigrams, over all rows, that a declared language needs for a model: about a kilobyte of text. With
#: fewer a model is hardly sharper than ``und``.
MIN_TRIGRAMS = 1000
#: Languages scored in one pass.
BLOCK_LANGUAGES = 256
#: Natural log below a row's likeliest language from which a language is left out; the evidence can make up for less than 150.
SPAN = 200.0
#: Languages whose counts a training task holds before it passes them on.
HELD = 64
#: Rows of a parent that a group's own rows are weighed against.
SMOOTHING = 20.0
#: What each trigram counts besides its occurrences: so little that text of unseen trigrams is unknown.
UNSEEN = 0.05
UNKNOWN_PRIOR = 1e-3
MIN_POSTERIOR = 0.5
#: Each byte is part of three trigrams, which are therefore not three independent findings.
TEMPER = 1 / 3


def _trigrams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """The row and the bins of its letter trigrams; runs of other ASCII count as one blank."""
    plain = np.arange(256, dtype=np.uint64)
    plain[[b for b in range(128) if not chr(b).isalpha()]] = 32
    for at, part in text_slices(texts):
        part = pc.utf8_lower(part)
        ends = np.frombuffer(part.buffers()[1], np.int64, len(part) + 1, part.offset * 8)
        data = part.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            code = plain[raw[a:b]]
            blank = code == 32
            code = code[~(blank & np.r_[True, blank[:-1]])] if len(code) else code
            code = np.concatenate(([np.uint64(32)], code, [np.uint64(32)])).astype(np.uint64)
            if len(code) > 2 and (code != 32).any():
                triple = (code[:-2] << np.uint64(16)) | (code[1:-1] << np.uint64(8)) | code[2:]
                yield at + i, (mix64(triple) >> np.uint64(64 - BINS_BITS)).astype(np.int64)
            else:
                yield at + i, np.empty(0, np.int64)


def _declared(column: Column) -> Column:
    return F.when((column != UNKNOWN) & (F.trim(column) != ""), column)


def trigram_counts(docs: DataFrame, text_col: str, declared_col: str) -> DataFrame:
    """(language, bin, n) of every declared language."""
    size = 1 << BINS_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for language, mine in sums.items():
                at = np.flatnonzero(mine)
                yield pa.record_batch(
                    [pa.repeat(pa.scalar(language), len(at)), pa.array(at.astype(np.int32)), pa.array(mine[at])],
                    names=["language", "bin", "n"],
                )
            sums.clear()

        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, bins in _trigrams(batch.column(1)):
                if len(bins):
                    if len(sums) == HELD and names[i] not in sums:
                        yield from passed_on()
                    mine = sums.setdefault(names[i], np.zeros(size, np.int64))
                    mine += np.bincount(bins, minlength=size)
        yield from passed_on()

    rows = docs.select(_declared(F.col(declared_col)).alias("language"), F.col(text_col).alias("text")).filter("language IS NOT NULL")
    return rows.mapInArrow(tidy(count), "language string, bin int, n long").groupBy("language", "bin").agg(F.sum("n").alias("n"))


def _with_enough(counts: DataFrame, min_trigrams: int) -> list[str]:
    enough = counts.groupBy("language").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_trigrams)
    return sorted(r["language"] for r in enough.select("language").collect())


def languages_of(docs: DataFrame, declared_col: str, text_col: str = "text", min_trigrams: int = MIN_TRIGRAMS) -> list[str]:
    """The declared languages of at least ``min_trigrams`` letter trigrams over all rows, in order."""
    return _with_enough(trigram_counts(docs, text_col, declared_col), min_trigrams)


def _model(counts: DataFrame, languages: list[str]) -> np.ndarray:
    index = {name: i for i, name in enumerate(languages)}
    size = 1 << BINS_BITS

    def vector(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.full(size, UNSEEN)
        counts[rows["bin"]] += rows["n"]
        logs = np.log(counts / counts.sum()).astype(np.float32)
        return pd.DataFrame({"language": [rows["language"].iloc[0]], "logs": [logs.tobytes()]})

    model = np.full((len(languages), size), -np.log(size), np.float32)
    mine = counts.filter(F.col("language").isin(languages))
    for row in mine.groupBy("language").applyInPandas(vector, "language string, logs binary").collect():
        model[index[row["language"]]] = np.frombuffer(row["logs"], np.float32)
    return model


def train(docs: DataFrame, text_col: str, declared_col: str, languages: list[str]) -> np.ndarray:
    """log P(bin | language), one row per language."""
    return _model(trigram_counts(docs.filter(F.col(declared_col).isin(languages)), text_col, declared_col), languages)


def _likelihoods(parts: DataFrame, model: np.ndarray, first: int) -> DataFrame:
    """``parts`` with, instead of its last column, the text: grams, and the logs of the likeliest of the
    model's languages, which are numbered from ``first``."""
    k = len(model)
    shared = parts.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))
    kept = parts.columns[:-1]
    step = max(1, (1 << 22) // max(k, 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            grams = np.zeros(batch.num_rows, np.int64)
            n = np.zeros(batch.num_rows + 1, np.int32)
            at, logs = [np.empty(0, np.int32)], [np.empty(0)]
            for i, bins in _trigrams(batch.column("text")):
                grams[i] = len(bins)
                if len(bins) and k:
                    each = TEMPER * sum(table[bins[j : j + step]].sum(axis=0, dtype=np.float64) for j in range(0, len(bins), step))
                    near = np.flatnonzero(each >= each.max() - SPAN)
                    at.append((near + first).astype(np.int32))
                    logs.append(each[near])
                    n[i + 1] = len(near)
            ends = pa.array(np.cumsum(n, dtype=np.int32))
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(grams),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(at))),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(logs))),
                ],
                names=[*kept, "grams", "at", "logs"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema.fields[:-1])
    return parts.mapInArrow(tidy(score), f"{fields}, grams long, at array<int>, logs array<double>")


def host_of_address(address: Column) -> Column:
    host = F.regexp_extract(ascii_lower(address), r"^(?:[^/?#]*?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.when(host != "", host)


def suffix_of_host(host: Column) -> Column:
    """The last label, of hosts that have several."""
    return F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str | None = "lang",
    host_col: str | None = "source",
    address_col: str | None = None,
    train_on: DataFrame | None = None,
    min_trigrams: int = MIN_TRIGRAMS,
    min_posterior: float = MIN_POSTERIOR,
    block: int = BLOCK_LANGUAGES,
) -> DataFrame:
    """One row per row of ``docs``: id, language, posterior, accepted. The host comes from
    ``host_col``, else from ``address_col``. ``train_on`` (same columns) has the rows to train on if
    not all; ``declared_col`` is needed for that."""
    source = docs if train_on is None else train_on
    counts = materialize(trigram_counts(source, text_col, declared_col))
    languages = _with_enough(counts, min_trigrams)
    k = len(languages)
    none = F.lit(None).cast("string")
    host = F.col(host_col) if host_col else host_of_address(F.col(address_col)) if address_col else none
    said = _declared(F.col(declared_col)) if declared_col else none
    parts = docs.select(
        F.col(id_col).alias("id"),
        said.alias("declared"),
        (said.isNotNull() & ~F.coalesce(said.isin(languages), F.lit(False))).alias("unmodelled"),
        host.cast("string").alias("host"),
        F.col(text_col).alias("text"),
    )
    if k <= block:
        scored = _likelihoods(parts, _model(counts, languages), 0)
    else:
        parts = materialize(parts.select(F.monotonically_increasing_id().alias("row"), "*"))
        passes = [materialize(_likelihoods(parts, _model(counts, languages[j : j + block]), j)) for j in range(0, k, block)]
        each = F.sort_array(F.collect_list(F.struct("at", "logs")))
        kept = [c for c in passes[0].columns if c not in ("row", "at", "logs")]
        scored = reduce(DataFrame.unionByName, passes).groupBy("row").agg(*(F.first(c).alias(c) for c in kept), each.alias("each"))
        scored = scored.select(*kept, *(F.flatten(F.col(f"each.{c}")).alias(c) for c in ("at", "logs")))
    soft = F.transform("logs", lambda x: F.exp(x - F.array_max("logs")))
    found = materialize(scored.withColumn("soft", F.transform(soft, lambda x: x / F.aggregate(soft, F.lit(0.0), lambda a, y: a + y))))
    found = found.withColumn("site", F.substring_index("host", ".", -2)).withColumn("suffix", suffix_of_host(F.col("host")))

    def sums(*keys: str) -> DataFrame:
        """Expected rows of each language by group."""
        each = found.select(*keys, F.explode(F.arrays_zip("at", "soft")).alias("e")).select(*keys, "e.at", "e.soft")
        for key in keys:
            each = each.filter(F.col(key).isNotNull())
        return each.groupBy(*keys, "at").agg(F.sum("soft").alias("n"))

    def by_group(*keys: str, name: str) -> DataFrame:
        """The same with one row per group: a map by language, and all together."""
        grouped = sums(*keys).groupBy(*keys)
        return grouped.agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias(f"{name}_n"), F.sum("n").alias(f"{name}_all"))

    whole = [0.0] * k
    for row in sums().collect():
        whole[row["at"]] = row["n"]
    rows = sum(whole)

    def array_of(values: list[float]) -> Column:
        return F.split(F.lit(",".join(map(repr, values))), ",").try_cast("array<double>")

    def of(name: str, language: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col(f"{name}_n"), language), F.lit(0.0))

    def smoothed(name: str, language: Column, parent: Column) -> Column:
        return (of(name, language) + SMOOTHING * parent) / (F.coalesce(f"{name}_all", F.lit(0.0)) + SMOOTHING)

    shares = array_of([(n + 1.0) / (rows + k) for n in whole])
    amounts = array_of(whole)

    def prior(language: Column) -> Column:
        return F.log(smoothed("host", language, smoothed("site", language, F.get(shares, language))))

    def given(name: str, language: Column) -> Column:
        """log P(value of the group | language), smoothed by the value's share."""
        share = (F.col(f"{name}_all") + 1.0) / (rows + 1.0)
        logs = F.log((of(name, language) + SMOOTHING * share) / (F.get(amounts, language) + SMOOTHING))
        return F.when(F.col(f"{name}_all").isNotNull(), logs).otherwise(0.0)

    hosts = by_group("host", "site", name="host").join(by_group("site", name="site"), "site").drop("site")
    fused = found.join(hosts, "host", "left").join(by_group("declared", name="said"), "declared", "left").join(by_group("suffix", name="suffix"), "suffix", "left")
    total = F.zip_with("logs", "at", lambda log, i: log + prior(i) + given("said", i) + given("suffix", i))
    unknown = F.col("grams") * F.lit(-TEMPER * float(np.log(1 << BINS_BITS))) + F.when(F.col("unmodelled"), 0.0).otherwise(float(np.log(UNKNOWN_PRIOR)))
    fused = fused.select("id", "grams", "declared", "unmodelled", "at", total.alias("total"), unknown.alias("unknown"))
    fused = fused.withColumn("top", F.greatest(F.array_max("total"), "unknown"))
    weight = F.aggregate("total", F.exp(F.col("unknown") - F.col("top")), lambda a, x: a + F.exp(x - F.col("top")))
    at = F.get("at", F.array_position("total", F.col("top")).cast("int") - 1)
    names = F.array(*map(F.lit, [*languages, UNKNOWN]))
    fused = fused.select(
        "id",
        "declared",
        "unmodelled",
        (F.col("grams") > 0).alias("read"),
        F.get(names, F.coalesce(at, F.lit(k))).alias("best"),
        (1 / weight).alias("chance"),
        (F.exp(F.col("unknown") - F.col("top")) / weight).alias("rest"),
    )
    sure = F.col("read") & (F.col("best") != UNKNOWN) & (F.col("chance") >= min_posterior)
    as_said = F.col("read") & F.col("unmodelled") & ~sure
    known = F.col("read") & F.lit(k > 0)
    return fused.select(
        F.col("id").alias(id_col),
        F.when(as_said, F.col("declared")).when(F.col("read"), F.col("best")).otherwise(UNKNOWN).alias("language"),
        F.when(as_said, F.col("rest")).when(known, F.col("chance")).otherwise(0.0).alias("posterior"),
        (sure | as_said).alias("accepted"),
    )
