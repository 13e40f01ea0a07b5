"""Presents the ``events`` table as raw hotspot text, one hotspot per event.

``events`` has no gaps, sentinels or bad text, so these are set by the ids, each over the whole
table. ``oracle/sql.py`` states the same mapping in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.schema import BRONZE_COLUMNS, REFERENCE_SATELLITE


def _every(column: str, n: int, rest: int = 0) -> Column:
    return F.col(column) % n == rest


def _text(value: Column) -> Column:
    return value.cast("string")


def _hundredths(value: Column) -> Column:
    """Non-negative integer count of hundredths as decimal text."""
    return F.concat(_text(F.floor(value / 100)), F.lit("."), F.lpad(_text(value % 100), 2, "0"))


def raw_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze columns, plus the event's own day as ``event_day``."""
    event, user = F.col("event_id"), F.col("user_id")
    view = {
        "id": F.when(~_every("event_id", 97), _text(event)),
        "lat": F.concat(F.lit("-"), _hundredths(event % 3300)),
        "lon": F.when(_every("event_id", 41), F.lit("W52")).otherwise(
            F.concat(F.lit("-"), _hundredths(3500 + event % 3800))
        ),
        "data_hora_gmt": F.when(_every("event_id", 29), F.lit("not-a-date")).otherwise(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
        ),
        "satelite": F.when(_every("event_id", 43), F.lit(None))
        .when(F.col("event_type") == "click", F.lit(REFERENCE_SATELLITE))
        .otherwise(F.col("event_type")),
        "municipio": F.concat(F.lit("MUN_"), _text(user)),
        "estado": F.concat(F.lit("UF_"), _text(user % 27)),
        "pais": F.lit("Brasil"),
        "municipio_id": F.when(
            _every("event_id", 3), F.concat(_text(1100000 + user), F.lit(".0"))
        ).otherwise(_text(1100000 + user)),
        "estado_id": F.when(_every("event_id", 31), F.lit("UF")).otherwise(_text(user % 27)),
        "pais_id": F.lit("33"),
        "numero_dias_sem_chuva": F.when(_every("event_id", 10), F.lit(None))
        .when(_every("event_id", 9), F.lit("-999"))
        .when(_every("event_id", 37), F.lit("40000"))
        .when(_every("event_id", 21), F.concat(_text(event % 120), F.lit(".0")))
        .otherwise(_text(event % 120)),
        "precipitacao": F.when(_every("event_id", 8), F.lit("-999"))
        .when(_every("event_id", 19), F.lit("abc"))
        .when(_every("event_id", 47), F.lit("NaN"))
        .when(_every("event_id", 53), F.lit("Infinity"))
        .otherwise(_hundredths(event % 500)),
        "risco_fogo": F.when(_every("user_id", 50, 7), F.lit(None))
        .when(_every("event_id", 59), F.lit("-999.0"))
        .otherwise(_hundredths(event % 101)),
        "bioma": F.when(
            ~_every("event_id", 17), F.concat(F.lit("BIOMA_"), _text(event % 6))
        ),
        "frp": F.when(_every("event_id", 11), F.lit(None))
        .when(_every("event_id", 7), F.lit("-999"))
        .when(_every("event_id", 13), F.lit("-3.20"))
        .otherwise(_text(F.col("value"))),
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        *(view[c].alias(c) for c in BRONZE_COLUMNS),
        F.to_date("ts").alias("event_day"),
        (F.col("event_id") % 23 == 0).alias("published_late"),
    )


def bronze_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as it lies in the lake: each row under its own day, some under the next one."""
    raw = raw_hotspots(spark, sf_dir)
    day = F.when(F.col("published_late"), F.date_add("event_day", 1)).otherwise(F.col("event_day"))
    return raw.select(
        *BRONZE_COLUMNS,
        F.date_format(day, "yyyy").alias("extract_year"),
        F.date_format(day, "MM").alias("extract_month"),
        F.date_format(day, "dd").alias("extract_day"),
    )


def event_dates(spark: SparkSession, sf_dir: str) -> list[dt.date]:
    """Every date from the first event to the last."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    first, last = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def write_month_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Writes the raw hotspots as monthly CSV and returns the path template for landing them."""
    raw = raw_hotspots(spark, sf_dir).withColumn("month", F.date_format("event_day", "yyyyMM"))
    raw.select(*BRONZE_COLUMNS, "month").write.partitionBy("month").option("header", True).csv(folder)
    return folder + "/month={month}"


def write_mixed_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """As ``write_month_files``, but rows of odd days have a column more and their columns the other way
    round, so that a month's folder holds files of two headers."""
    raw = raw_hotspots(spark, sf_dir)
    day = F.dayofmonth("event_day")
    raw = raw.withColumns({"month": F.date_format("event_day", "yyyyMM"), "nova": F.concat(F.lit("N"), day.cast("string"))})
    plain = raw.where(day % 2 == 0).select(*BRONZE_COLUMNS, "month")
    turned = raw.where(day % 2 == 1).select("nova", *reversed(BRONZE_COLUMNS), "month")
    for part in (plain, turned):
        part.write.mode("append").partitionBy("month").option("header", True).csv(folder)
    return folder + "/month={month}"
