"""What the driver asks of the file system itself: which files a path has, their first lines, their footers.

Listing is Spark's. Each question opens a file and reads a few kilobytes of it, whatever its size, from a
bounded number of threads; no job is started for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")
R = TypeVar("R")

THREADS = 16
_BUFFER = 4096


def side_by_side(call: Callable[[T], R], items: Sequence[T]) -> list[R]:
    """``call`` of every item, in order, some at a time."""
    if not items:
        return []
    with ThreadPoolExecutor(min(THREADS, len(items))) as pool:
        return list(pool.map(call, items))


def hadoop_path(spark: SparkSession, uri: str):
    """The path of a uri as Spark reports it, with its escapes resolved."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(path(spark._jvm.java.net.URI(uri)).toString())  # once more, as file:/// and file:/ are alike


def data_files(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Uris of the files that Spark would read under ``paths``, written as in ``_metadata.file_path``; a path
    that is not there raises."""
    return sorted(hadoop_path(spark, f).toUri().toString() for f in spark.read.text(list(paths)).inputFiles())


def first_line(spark: SparkSession, uri: str) -> str | None:
    """The first line that is not blank, or None. Reads up to its end, through the codec of the file's name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = hadoop_path(spark, uri)
    stream = path.getFileSystem(conf).open(path, _BUFFER)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        if codec is not None:
            stream = codec.createInputStream(stream)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"), _BUFFER)
        line = lines.readLine()
        while line is not None and all(c <= " " for c in line):
            line = lines.readLine()
        return line
    finally:
        stream.close()


def parquet_time_kind(spark: SparkSession, uri: str, column: str) -> str | None:
    """How a Parquet file's footer says that ``column`` holds times: ``instant`` (INT96, or adjusted to UTC),
    ``local`` (not adjusted), or None for no such column or another type."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parquet = jvm.org.apache.parquet.hadoop
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(hadoop_path(spark, uri), conf))
    try:
        schema = reader.getFileMetaData().getSchema()
        for field in schema.getFields():
            if field.getName().lower() == column.lower() and field.isPrimitive():
                if field.getPrimitiveTypeName().toString() == "INT96":
                    return "instant"
                said = field.getLogicalTypeAnnotation()
                kind = said.toString() if said is not None else ""
                if kind.startswith("TIMESTAMP("):
                    return "instant" if kind.endswith("true)") else "local"
        return None
    finally:
        reader.close()
