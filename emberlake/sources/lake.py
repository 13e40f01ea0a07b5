"""Date-partitioned tables: addressing, reading and replacing dates."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.schema import DATE_COLUMNS
from emberlake.sources.files import hadoop_path, parquet_time_kind, side_by_side

_PARTITIONS_PER_DATE = 16
# Beyond this a shuffle keeps only average block sizes, and large dates would go unnoticed.
_MAX_PARTITIONS = 2000
_SALTS = 8


@dataclass(frozen=True)
class Lake:
    """Where the layers of one lake live. The sub-paths can be set to those of an existing lake."""

    root: str
    bronze_path: str = "bronze/focos/diario"
    silver_path: str = "silver/focos/diario"
    gold_path: str = "gold/{table}/diario"

    @property
    def bronze(self) -> str:
        return f"{self.root}/{self.bronze_path}"

    @property
    def silver(self) -> str:
        return f"{self.root}/{self.silver_path}"

    def gold(self, table: str) -> str:
        return f"{self.root}/{self.gold_path.format(table=table)}"


def date_leaf(table: str, date: dt.date) -> str:
    """Directory of one date, zero-padded."""
    return f"{table}/extract_year={date:%Y}/extract_month={date:%m}/extract_day={date:%d}"


def date_leaves(table: str, dates: Sequence[dt.date] | None) -> list[str]:
    """Paths to read for ``dates``, or the whole table. Naming the leaves keeps the file listing to
    the dates asked for, however long the lake's history; a date never written raises."""
    return [table] if dates is None else [date_leaf(table, d) for d in dates]


def read_dates(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    dates: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Parquet rows of ``dates`` with their partition columns as the zero-padded text on disk. The
    schema is given, so no file is opened to infer it."""
    return _read_leaves(spark, table, schema, date_leaves(table, dates))


def _read_leaves(spark: SparkSession, table: str, schema: T.StructType, leaves: Sequence[str]) -> DataFrame:
    full = T.StructType(schema.fields + [T.StructField(c, T.StringType()) for c in DATE_COLUMNS])
    return spark.read.schema(full).option("basePath", table).parquet(*leaves)


def read_times_as_written(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    dates: Sequence[dt.date] | None,
    column: str,
    source_zone: str | None,
) -> DataFrame:
    """As ``read_dates``, with ``column`` as the time that was written, though some dates may come from a
    writer that stored it as an instant, taking the text for local time of a zone.

    The footer of one file a date says which they are; a writer replaces a date as a whole. Instants are
    turned back with ``source_zone``, and without it they raise: read as they are they would be shifted.
    """
    frame = read_dates(spark, table, schema, dates)
    one_of: dict[str, str] = {}
    for file in sorted(frame.inputFiles()):
        one_of.setdefault(file.rsplit("/", 1)[0], file)
    kinds = side_by_side(lambda file: parquet_time_kind(spark, file, column), list(one_of.values()))
    leaves: dict[bool, list[str]] = {False: [], True: []}
    for folder, kind in zip(one_of, kinds):
        leaves[kind == "instant"].append(hadoop_path(spark, folder).toString())
    if not leaves[True]:
        return frame
    if source_zone is None:
        raise ValueError(
            f"{column} is stored as an instant in {leaves[True][0]} and {len(leaves[True]) - 1} more dates: "
            "say with source_zone which zone its writer took the text for"
        )
    instants = [T.StructField(f.name, T.TimestampType()) if f.name == column else f for f in schema.fields]
    session_clock = F.col(column).cast("timestamp_ntz")
    written = F.convert_timezone(F.current_timezone(), F.lit(source_zone), session_clock)
    zoned = _read_leaves(spark, table, T.StructType(instants), leaves[True]).withColumn(column, written)
    return zoned.unionByName(_read_leaves(spark, table, schema, leaves[False])) if leaves[False] else zoned


def write_dates(
    df: DataFrame,
    table: str,
    dates: Sequence[dt.date],
    *,
    columns: Sequence[str] | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    order_by: Sequence[Column] = (),
    compact: bool = True,
) -> None:
    """Replaces ``dates`` of ``table`` with the rows of ``df``, placed by their ``DATREF`` (yyyyMMdd)
    and cut to ``columns``.

    Other dates stay. All files are staged beside the table's dates first: those of the rows, by one job, and an
    empty file for each date of ``dates`` that came out without rows, by one small job however many they are. Then
    the staged dates replace the old ones, empty dates like the others, by renames side by side. Until then a
    failed or killed call leaves every date as it was, and after it nothing is left to do; one killed between two
    renames leaves some dates old, and is repeated. Any committer will do, as the staging folder is new.

    With ``compact`` the rows are rebalanced on the date first: a small date becomes one file, and
    adaptive execution splits a large one by size, so no date passes through a single task. There are
    several times more hash partitions than dates, so that a small date seldom shares one with a large
    date and its splits; adaptive execution joins the empty and small ones again. In a session without
    adaptive execution a date is dealt to at most ``_SALTS`` tasks instead. Without ``compact`` each task
    writes what it has, with no shuffle.
    """
    options = options or {}
    columns = columns or df.columns
    spark = df.sparkSession
    placed = df.select(
        *columns,
        F.substring("DATREF", 1, 4).alias("extract_year"),
        F.substring("DATREF", 5, 2).alias("extract_month"),
        F.substring("DATREF", 7, 2).alias("extract_day"),
    )
    if compact:
        placed = rows_together(placed, DATE_COLUMNS, len(dates))
    if order_by:
        placed = placed.sortWithinPartitions(*DATE_COLUMNS, *order_by)
    with _staging(spark, table) as staged:
        placed.write.format(fmt).options(**options).partitionBy(*DATE_COLUMNS).save(staged)
        leaves = _leaves_under(spark, staged)
        empty = sorted({date_leaf("", d) for d in dates}.difference(leaves))
        if empty:
            # A filter that is never true: Catalyst plans no scan for it.
            nothing = df.select(*columns).where(F.lit(False)).coalesce(1)
            nothing.write.format(fmt).options(**options).save(f"{staged}/_empty")
            _copy_to_leaves(spark, f"{staged}/_empty", staged, empty)
        _swap_in(spark, staged, table, [*leaves, *empty])


@contextmanager
def _staging(spark: SparkSession, table: str) -> Iterator[str]:
    """A folder below the table that readers skip by its name, gone in the end."""
    folder = f"{table}/_staging-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        files, path = _files_of(spark, folder)
        files.delete(path, True)


def _files_of(spark: SparkSession, folder: str):
    """The file system of a folder, and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _leaves_under(spark: SparkSession, staged: str) -> list[str]:
    """The date folders that a job has written, from the staging folder on."""
    files, path = _files_of(spark, staged)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path, "/".join(f"{c}=*" for c in DATE_COLUMNS))
    found = []
    for status in files.globStatus(pattern):
        leaf = status.getPath()
        names = [leaf.getParent().getParent().getName(), leaf.getParent().getName(), leaf.getName()]
        found.append("/" + "/".join(names))
    return sorted(found)


def _copy_to_leaves(spark: SparkSession, template: str, staged: str, leaves: Sequence[str]) -> None:
    """A copy of the template's files in each leaf."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files, _ = _files_of(spark, staged)
    made = [f.getPath() for f in files.globStatus(path(f"{template}/part-*"))]

    def fill(leaf: str) -> None:
        files.mkdirs(path(staged + leaf))
        for file in made:
            target = path(path(staged + leaf), file.getName())
            jvm.org.apache.hadoop.fs.FileUtil.copy(files, file, files, target, False, conf)

    side_by_side(fill, leaves)


def _swap_in(spark: SparkSession, staged: str, table: str, leaves: Sequence[str]) -> None:
    """Each leaf of ``staged`` in place of the table's own."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files, _ = _files_of(spark, table)

    def swap(leaf: str) -> None:
        target = path(table + leaf)
        files.delete(target, True)
        files.mkdirs(target.getParent())
        if not files.rename(path(staged + leaf), target):
            raise OSError(f"cannot move the staged files of {table + leaf} into place")

    side_by_side(swap, leaves)


def rows_together(rows: DataFrame, keys: Sequence[str], groups: int) -> DataFrame:
    """Rows of equal ``keys`` in few tasks, as ``write_dates`` says of dates; ``groups`` is about how many keys there are."""
    conf = rows.sparkSession.conf
    asked = int(conf.get("spark.sql.shuffle.partitions"))
    partitions = min(max(asked, _PARTITIONS_PER_DATE * groups), _MAX_PARTITIONS)
    if conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", partitions, *keys)
    salt = (F.rand(1) * _SALTS).cast("int")
    return rows.withColumn("_salt", salt).repartition(partitions, *keys, "_salt").drop("_salt")
