"""Bronze text rows to typed silver rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.functions.measures import missing_to_sentinel
from emberlake.functions.parsing import number, wall_clock, whole_number
from emberlake.schema import BRONZE_COLUMNS, DATE_COLUMNS, METRICS, SILVER_SCHEMA


def version_column(version_ts: dt.datetime | None) -> Column:
    """Processing time, or the given one where a run must be repeatable."""
    return F.current_timestamp() if version_ts is None else F.lit(version_ts).cast("timestamp")


def at_date(bronze: DataFrame, ref_date: dt.date) -> DataFrame:
    """Marks all rows as extracted for ``ref_date``."""
    text = (f"{ref_date:%Y}", f"{ref_date:%m}", f"{ref_date:%d}")
    return bronze.withColumns({c: F.lit(t) for c, t in zip(DATE_COLUMNS, text)})


def rows_of_day(bronze: DataFrame) -> DataFrame:
    """Rows whose own date is the date of the partition they lie in, for any number of dates."""
    year, month, day = (F.col(c).cast("int") for c in DATE_COLUMNS)
    return bronze.where(
        F.to_date(wall_clock("data_hora_gmt")) == F.make_date(year, month, day)
    ).select(*DATE_COLUMNS, *BRONZE_COLUMNS)


def clean_metrics(rows: DataFrame) -> DataFrame:
    """Parses the metrics and marks absent ones with the sentinel.

    The parsed value gets a column of its own first: Catalyst keeps the two projections apart, so a
    row's text is parsed once although the rule names the value several times.
    """
    parsed = rows.withColumns({f"_{m.column}": number(m.column) for m in METRICS})
    return parsed.withColumns(
        {
            m.column: missing_to_sentinel(m, F.col(m.column), F.col(f"_{m.column}"))
            for m in METRICS
        }
    ).drop(*(f"_{m.column}" for m in METRICS))


def type_rows(cleaned: DataFrame, version_ts: dt.datetime | None = None) -> DataFrame:
    """The 23 silver columns in order."""
    year, month, day = (F.col(c).cast("int") for c in DATE_COLUMNS)
    when = F.col("data_hora_gmt")
    special = {
        "id_foco": F.col("id"),
        "DATREF": (year * 10000 + month * 100 + day).cast("string"),
        "DATVER": version_column(version_ts),
        "ANO": F.year(when).cast("smallint"),
        "MES": F.month(when).cast("smallint"),
        "DIA": F.dayofmonth(when).cast("smallint"),
        "HORA": F.hour(when).cast("smallint"),
        "MINUTO": F.minute(when).cast("smallint"),
        "lat": number("lat"),
        "lon": number("lon"),
        "municipio_id": whole_number(number("municipio_id"), "int"),
        "estado_id": whole_number(number("estado_id"), "int"),
        "pais_id": whole_number(number("pais_id"), "int"),
        "numero_dias_sem_chuva": whole_number(F.col("numero_dias_sem_chuva"), "smallint"),
    }
    timed = cleaned.withColumn("data_hora_gmt", wall_clock("data_hora_gmt"))
    return timed.select(*(special.get(c, F.col(c)).alias(c) for c in SILVER_SCHEMA.names))


def build_silver(bronze: DataFrame, version_ts: dt.datetime | None = None) -> DataFrame:
    """Silver rows of every extract date present in ``bronze``, without a shuffle."""
    return type_rows(clean_metrics(rows_of_day(bronze)), version_ts)
