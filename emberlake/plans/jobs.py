"""The jobs of the lake. Each takes one date or many and runs them together; errors are raised."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators.gold import (
    finish_measures,
    merge_measures,
    partial_measures,
    reference_rows,
)
from emberlake.operators.silver import build_silver
from emberlake.schema import GOLD_TABLES, REFERENCE_SATELLITE, SILVER_SCHEMA, gold_schema
from emberlake.sources import bronze
from emberlake.sources.lake import Lake, read_dates, read_times_as_written, write_dates
from emberlake.sources.shared import stored_once


def yesterday() -> dt.date:
    """The default reference date, in UTC."""
    return dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)


def bronze_job(
    spark: SparkSession,
    lake: Lake,
    source: str,
    dates: Sequence[dt.date],
    layout: str = "snapshot",
    compact: bool = True,
) -> None:
    """Lands the monthly CSV files behind ``dates``, as ``bronze.route_to_dates`` says of ``layout``."""
    bronze.land(spark, source, lake.bronze, dates, layout, compact)


def silver_job(
    spark: SparkSession,
    lake: Lake,
    dates: Sequence[dt.date],
    version_ts: dt.datetime | None = None,
    compact: bool = True,
) -> None:
    """Cleans and types the landed rows of ``dates``.

    Files are sorted by satellite: the write sorts by date anyway, and gold then skips row groups and
    pages of other satellites. ``compact=False`` saves the shuffle of all rows where the
    landed dates are large and hold few foreign rows, as after a large backfill; elsewhere it leaves
    many small files.
    """
    rows = build_silver(bronze.read_bronze(spark, lake.bronze, dates), version_ts)
    write_dates(rows, lake.silver, dates, order_by=[F.col("satelite")], compact=compact)


def read_silver(
    spark: SparkSession,
    lake: Lake,
    dates: Sequence[dt.date] | None = None,
    source_zone: str | None = None,
) -> DataFrame:
    """Silver rows of ``dates``. ``source_zone`` is for dates of a writer that stored ``data_hora_gmt`` as an
    instant, taking the text for local time of that zone: it is turned back into the time as written. Such dates
    raise without it, and may stand beside others."""
    return read_times_as_written(spark, lake.silver, SILVER_SCHEMA, dates, "data_hora_gmt", source_zone)


def read_gold(
    spark: SparkSession, lake: Lake, table: str, dates: Sequence[dt.date] | None = None
) -> DataFrame:
    return read_dates(spark, lake.gold(table), gold_schema(GOLD_TABLES[table]), dates)


def gold_job(
    spark: SparkSession,
    lake: Lake,
    dates: Sequence[dt.date],
    tables: Sequence[str] = tuple(GOLD_TABLES),
    version_ts: dt.datetime | None = None,
    satellite: str = REFERENCE_SATELLITE,
    source_zone: str | None = None,
) -> None:
    """Aggregates silver into the gold ``tables``.

    Silver is scanned and shuffled once, into measures by all keys of all tables. That result is
    bounded by dates x places, however many hotspots there are; each table is a roll-up of it. The
    roll-ups are small jobs and are written side by side. ``source_zone`` is that of ``read_silver``.
    """
    rows = reference_rows(read_silver(spark, lake, dates, source_zone), satellite)
    keys = sorted({key for table in tables for key in GOLD_TABLES[table]})
    measures = partial_measures(rows, keys)
    with stored_once(measures) if len(tables) > 1 else nullcontext(measures) as stored:

        def write(table: str) -> None:
            own = list(GOLD_TABLES[table])
            rolled = stored if sorted(own) == keys else merge_measures(stored, own)
            gold = finish_measures(rolled, own, version_ts)
            write_dates(gold, lake.gold(table), dates, order_by=[F.desc("QUANTIDADE_FOCO")])

        with ThreadPoolExecutor(len(tables)) as pool:
            # Each thread carries the caller's tags, job group and scheduler pool.
            running = [pool.submit(inheritable_thread_target(spark)(write), t) for t in tables]
            for job in running:
                job.result()


def daily_chain(
    spark: SparkSession,
    lake: Lake,
    source: str,
    dates: Sequence[dt.date] | None = None,
    version_ts: dt.datetime | None = None,
    layout: str = "snapshot",
    compact: bool | None = None,
) -> None:
    """Land, silver, then the three gold tables, all for the same dates.

    Landing ``by_date`` brings a date's own rows together, so silver is then written without another
    shuffle unless ``compact`` asks for it.
    """
    dates = sorted(set(dates)) if dates else [yesterday()]
    bronze_job(spark, lake, source, dates, layout)
    silver_job(spark, lake, dates, version_ts, layout != "by_date" if compact is None else compact)
    gold_job(spark, lake, dates, version_ts=version_ts)
