"""Raw hotspot CSV: scanning it, and landing it in date partitions.

Files are matched by their own header: a column may stand anywhere, be missing from the files of one month
or be there in addition. Landed rows keep every column of their source.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import uuid
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.parsing import wall_clock
from emberlake.schema import BRONZE_COLUMNS, DATE_COLUMNS
from emberlake.sources.files import data_files, first_line, hadoop_path, side_by_side
from emberlake.sources.lake import date_leaves, rows_together, write_dates

# Values keep their blanks; Spark's CSV writer would trim them otherwise.
_CSV_WRITE = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# A snapshot lies in the lake once for each date.
_LAYOUT_WRITE = {"snapshot": {"compression": "gzip", "zlib.compress.level": "FIVE"}}
LAYOUTS = ("snapshot", "by_date")
# Dates of a file that get tasks of their own; a month has no more.
_MAX_COPIES = 31


def _by_header(spark: SparkSession, files: Sequence[str]) -> list[list[str]]:
    """``files`` without empty ones, those with the same first line together."""
    groups: dict[str, list[str]] = {}
    for file, header in zip(files, side_by_side(partial(first_line, spark), files)):
        if header is not None:
            groups.setdefault(header, []).append(file)
    return sorted(groups.values())


def _scan(
    spark: SparkSession, files: Sequence[str], base: str | None = None, file_as: str | None = None
) -> DataFrame | None:
    """All columns of the CSV ``files`` as text, each file by its own header; None without
    files. Needed columns get their usual spelling; ``file_as`` adds the file of each row."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    reader = reader.option("basePath", base) if base else reader
    usual = {c.lower(): c for c in (*BRONZE_COLUMNS, *DATE_COLUMNS)}
    frames = []
    for group in _by_header(spark, files):
        df = reader.csv([hadoop_path(spark, f).toString() for f in group])
        # Renamed only where the name differs: else Spark sees one scan, used twice in a plan, as two.
        names = {c: usual.get(c.lower(), c) for c in df.columns}
        own = [F.col(f"`{c}`") if c == name else F.col(f"`{c}`").alias(name) for c, name in names.items()]
        frames.append(df.select(*own, *([F.col("_metadata.file_path").alias(file_as)] if file_as else [])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def read_raw(spark: SparkSession, path: str, all_columns: bool = False) -> DataFrame:
    """The needed columns of the CSV files under ``path`` as text, and the others behind them if asked for."""
    return _needed(_scan(spark, data_files(spark, [path])), path, all_columns=all_columns)


def read_bronze(
    spark: SparkSession,
    table: str,
    dates: Sequence[dt.date] | None = None,
    all_columns: bool = False,
) -> DataFrame:
    """Landed rows of ``dates`` with their partition columns, zero-padded as on disk."""
    files = data_files(spark, date_leaves(table, dates))
    df = _needed(_scan(spark, files, table), table, DATE_COLUMNS, all_columns)
    width = dict(zip(DATE_COLUMNS, (4, 2, 2)))
    return df.withColumns({c: F.lpad(F.col(c).cast("string"), n, "0") for c, n in width.items()})


def _needed(
    df: DataFrame | None, path: str, extra: Sequence[str] = (), all_columns: bool = False
) -> DataFrame:
    """Checks the needed columns and puts them first, then others, then ``extra``."""
    if df is None:
        raise ValueError(f"{path} holds no CSV file with a header")
    absent = [c for c in (*BRONZE_COLUMNS, *extra) if c not in df.columns]
    if absent:
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}")
    others = [c for c in df.columns if c not in (*BRONZE_COLUMNS, *extra)] if all_columns else []
    return df.select(*(F.col(f"`{c}`") for c in (*BRONZE_COLUMNS, *others, *extra)))


def month_path(source: str, date: dt.date) -> str:
    """Path of the monthly file that holds ``date``; ``{month}`` in ``source`` stands for yyyyMM."""
    return source.format(month=f"{date:%Y%m}")


def route_to_dates(raw: DataFrame, dates: Sequence[dt.date], layout: str = "snapshot") -> DataFrame:
    """Adds ``DATREF``, the extract dates each raw row lands in.

    ``snapshot``: the whole file under every date, as in daily runs. ``by_date``, for backfills: each row
    once, in its own date when that is asked for, else in the latest date of the file. Silver and gold are
    the same from both.
    """
    return _routed(raw, F.array(*(F.lit(f"{d:%Y%m%d}") for d in sorted(dates))), layout)


def _routed(raw: DataFrame, dates: Column, layout: str) -> DataFrame:
    """As ``route_to_dates``, with each row's own array of dates as yyyyMMdd."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout is one of {', '.join(LAYOUTS)}")
    if layout == "snapshot":
        return raw.withColumn("DATREF", F.explode(dates))
    own = F.date_format(F.to_date(wall_clock("data_hora_gmt")), "yyyyMMdd")
    return raw.withColumn("DATREF", F.when(F.array_contains(dates, own), own).otherwise(F.array_max(dates)))


def _copied(raw: DataFrame, file_set: str, dates: Sequence[Sequence[str]]) -> DataFrame:
    """As ``_routed`` for ``snapshot``, for rows that have just been shuffled: those with n in ``file_set`` are for ``dates[n]``.

    Each date of a file is a branch that reads the shuffled rows once more, so they are kept once and not once a
    date, and no task sorts more rows than it has read. The dates are part of the plan and not of the rows, which
    so stay small. Beyond ``_MAX_COPIES`` a branch takes several dates.
    """
    most = max(map(len, dates))
    width = math.ceil(most / _MAX_COPIES)
    parts = []
    for start in range(0, most, width):
        some = F.from_json(F.lit(json.dumps([d[start : start + width] for d in dates])), "array<array<string>>")
        # Outer, as Spark would push what it infers of an inner one below the shuffle, which then differed by branch.
        parts.append(raw.withColumn("DATREF", F.explode_outer(F.get(some, file_set))).where("DATREF IS NOT NULL"))
    return reduce(DataFrame.unionAll, parts)


def land(
    spark: SparkSession,
    source: str,
    table: str,
    dates: Sequence[dt.date],
    layout: str = "snapshot",
    compact: bool = True,
) -> None:
    """Lands the monthly files behind ``dates`` in the bronze table, with all columns and values unchanged.
    All months are one scan for each header that their files have: the months' listings say which dates a
    file is for, and each row is sent to the dates of its file. What a date holds depends on ``layout`` alone, not
    on the other dates of the call. ``compact=False`` saves the shuffle that brings a date's rows together in
    few files; that of a ``snapshot`` is made before its rows are copied to their dates, of which each gets files of
    its own, compressed."""
    months: dict[str, list[str]] = {}
    for date in sorted(set(dates)):
        months.setdefault(month_path(source, date), []).append(f"{date:%Y%m%d}")
    listings = side_by_side(lambda path: data_files(spark, [path]), list(months))
    own: dict[str, set[str]] = {}
    for days, files in zip(months.values(), listings):
        for file in files:
            own.setdefault(file, set()).update(days)
    file_as, days_as = (f"_{name}_{uuid.uuid4().hex}" for name in ("file", "days"))
    raw = _scan(spark, sorted(own), file_as=file_as)
    raw = _needed(raw, ", ".join(months), [file_as], all_columns=True)
    days = {file: tuple(sorted(d)) for file, d in own.items()}

    def with_days(values: dict, kind: str) -> DataFrame:
        """One entry for each file that was listed just now."""
        entries = spark.createDataFrame(list(values.items()), f"{file_as} string, {days_as} {kind}")
        return raw.join(F.broadcast(entries), file_as).drop(file_as)

    if layout == "snapshot" and compact:
        sets = {d: n for n, d in enumerate(sorted(set(days.values())))}
        together = rows_together(with_days({f: sets[d] for f, d in days.items()}, "int"), [days_as], len(months))
        rows, compact = _copied(together, days_as, list(sets)), False
    else:
        rows = _routed(with_days(days, "array<string>"), F.col(days_as), layout)
    rows = rows.drop(days_as)
    write_dates(
        rows,
        table,
        dates,
        columns=[c for c in rows.columns if c != "DATREF"],
        fmt="csv",
        options=_CSV_WRITE | _LAYOUT_WRITE.get(layout, {}),
        compact=compact,
    )
