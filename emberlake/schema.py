"""Column names, types and constants of the three lake layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# They must equal those of the published data and of existing lakes.
SENTINEL = -999
REFERENCE_SATELLITE = "AQUA_M-T"
DATE_COLUMNS = ("extract_year", "extract_month", "extract_day")
BRONZE_COLUMNS = (
    "id",
    "lat",
    "lon",
    "data_hora_gmt",
    "satelite",
    "municipio",
    "estado",
    "pais",
    "municipio_id",
    "estado_id",
    "pais_id",
    "numero_dias_sem_chuva",
    "precipitacao",
    "risco_fogo",
    "bioma",
    "frp",
)
GOLD_TABLES = {
    "foco_bioma": ("bioma",),
    "foco_estado": ("estado",),
    "foco_municipio": ("estado", "municipio"),
}


@dataclass(frozen=True)
class Metric:
    """A measured value of one hotspot and how gold reports it."""

    column: str
    label: str
    silver_type: T.DataType
    negative_is_missing: bool = False

    @property
    def integral(self) -> bool:
        return isinstance(self.silver_type, T.ShortType)


METRICS = (
    Metric("frp", "FRP", T.DoubleType(), negative_is_missing=True),
    Metric("numero_dias_sem_chuva", "DIAS_SEM_CHUVA", T.ShortType()),
    Metric("precipitacao", "PRECIPITACAO", T.DoubleType()),
    Metric("risco_fogo", "RISCO_FOGO", T.DoubleType()),
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("id_foco", T.StringType()),
        T.StructField("data_hora_gmt", T.TimestampNTZType()),
        T.StructField("DATREF", T.StringType()),
        T.StructField("DATVER", T.TimestampType()),
        T.StructField("ANO", T.ShortType()),
        T.StructField("MES", T.ShortType()),
        T.StructField("DIA", T.ShortType()),
        T.StructField("HORA", T.ShortType()),
        T.StructField("MINUTO", T.ShortType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("satelite", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("estado", T.StringType()),
        T.StructField("pais", T.StringType()),
        T.StructField("municipio_id", T.IntegerType()),
        T.StructField("estado_id", T.IntegerType()),
        T.StructField("pais_id", T.IntegerType()),
        T.StructField("numero_dias_sem_chuva", T.ShortType()),
        T.StructField("precipitacao", T.DoubleType()),
        T.StructField("risco_fogo", T.DoubleType()),
        T.StructField("bioma", T.StringType()),
        T.StructField("frp", T.DoubleType()),
    ]
)


def gold_schema(keys: tuple[str, ...]) -> T.StructType:
    """Schema of the gold table grouped by ``keys``."""
    schema = T.StructType()
    schema.add("DATREF", T.StringType()).add("DATVER", T.TimestampType())
    for key in keys:
        schema.add(key.upper(), T.StringType())
    schema.add("QUANTIDADE_FOCO", T.LongType())
    for metric in METRICS:
        total = T.LongType() if metric.integral else T.DoubleType()
        extreme = T.IntegerType() if metric.integral else T.DoubleType()
        schema.add(f"SUM_{metric.label}", total)
        schema.add(f"AVG_{metric.label}", T.DoubleType())
        schema.add(f"MIN_{metric.label}", extreme)
        schema.add(f"MAX_{metric.label}", extreme)
    return schema
