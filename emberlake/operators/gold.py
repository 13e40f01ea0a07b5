"""Silver rows to daily statistics of the reference satellite.

Every statistic follows from counts, sums, minima and maxima, which merge. ``partial_measures``
computes those once, at any grain; ``merge_measures`` brings them to coarser keys; and
``finish_measures`` turns them into the published columns. So several gold tables can share one
scan and one large shuffle, and a hot key shrinks to one row per task before it is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.functions.measures import is_valid, round_cents, zero_filled
from emberlake.operators.silver import version_column
from emberlake.schema import METRICS, REFERENCE_SATELLITE

# Silver's own DATVER is part of the group: two versions of a date give two rows per key.
_VERSIONED_DATE = ("DATREF", "DATVER")


def reference_rows(silver: DataFrame, satellite: str = REFERENCE_SATELLITE) -> DataFrame:
    return silver.where(F.col("satelite") == satellite)


def partial_measures(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mergeable counts, sums, minima and maxima per date, version and ``keys``."""
    filled = rows.select(
        *_VERSIONED_DATE,
        *keys,
        "id_foco",
        *(F.when(is_valid(m), 1).alias(f"valid_{m.label}") for m in METRICS),
        *(zero_filled(m).alias(f"filled_{m.label}") for m in METRICS),
    )
    measures = [F.count("id_foco").alias("n_ids"), F.count(F.lit(1)).alias("n_rows")]
    for m in METRICS:
        measures += [
            F.count(f"valid_{m.label}").alias(f"n_{m.label}"),
            F.sum(f"filled_{m.label}").alias(f"sum_{m.label}"),
            F.min(f"filled_{m.label}").alias(f"min_{m.label}"),
            F.max(f"filled_{m.label}").alias(f"max_{m.label}"),
        ]
    return filled.groupBy(*_VERSIONED_DATE, *keys).agg(*measures)


def merge_measures(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rolls the result of ``partial_measures`` up to fewer keys."""
    measures = [F.sum("n_ids").alias("n_ids"), F.sum("n_rows").alias("n_rows")]
    for m in METRICS:
        for name, merge in (("n", F.sum), ("sum", F.sum), ("min", F.min), ("max", F.max)):
            measures.append(merge(f"{name}_{m.label}").alias(f"{name}_{m.label}"))
    return partials.groupBy(*_VERSIONED_DATE, *keys).agg(*measures)


def finish_measures(
    partials: DataFrame, keys: Sequence[str], version_ts: dt.datetime | None = None
) -> DataFrame:
    """The published gold columns. AVG divides by all rows of the group, valid or not; a group
    without any valid value has NULL statistics."""
    columns = [F.col("DATREF"), version_column(version_ts).alias("DATVER")]
    columns += [F.col(k).alias(k.upper()) for k in keys]
    columns.append(F.col("n_ids").alias("QUANTIDADE_FOCO"))
    for m in METRICS:
        total, least, most = (F.col(f"{s}_{m.label}") for s in ("sum", "min", "max"))
        mean = total.cast("double") / F.col("n_rows")
        if not m.integral:
            total, least, most = round_cents(total), round_cents(least), round_cents(most)
        measured = F.col(f"n_{m.label}") > 0
        columns += [
            F.when(measured, total).alias(f"SUM_{m.label}"),
            F.when(measured, round_cents(mean)).alias(f"AVG_{m.label}"),
            F.when(measured, least).alias(f"MIN_{m.label}"),
            F.when(measured, most).alias(f"MAX_{m.label}"),
        ]
    return partials.select(*columns)


def build_gold(
    silver: DataFrame,
    keys: Sequence[str],
    version_ts: dt.datetime | None = None,
    satellite: str = REFERENCE_SATELLITE,
) -> DataFrame:
    """One gold table straight from silver."""
    return finish_measures(partial_measures(reference_rows(silver, satellite), keys), keys, version_ts)


def most_first(gold: DataFrame) -> DataFrame:
    """Descending by count over the whole result; the order among ties is open."""
    return gold.orderBy(F.desc("QUANTIDADE_FOCO"))
