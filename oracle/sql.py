"""DuckDB SQL for the registered queries, written from the rules and not from the Spark code."""

from __future__ import annotations

# Column names and labels of the published data.
METRIC_LABELS = {
    "frp": "FRP",
    "numero_dias_sem_chuva": "DIAS_SEM_CHUVA",
    "precipitacao": "PRECIPITACAO",
    "risco_fogo": "RISCO_FOGO",
}

_RAW_COLUMNS = """\
id, lat, lon, data_hora_gmt, satelite, municipio, estado, pais, municipio_id, estado_id, pais_id,
    numero_dias_sem_chuva, precipitacao, risco_fogo, bioma, frp"""


def _hundredths(n: str) -> str:
    return f"CAST(({n}) // 100 AS VARCHAR) || '.' || lpad(CAST(({n}) % 100 AS VARCHAR), 2, '0')"


_RAW = f"""raw AS (
  SELECT
    CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS id,
    '-' || {_hundredths("event_id % 3300")} AS lat,
    CASE WHEN event_id % 41 = 0 THEN 'W52'
         ELSE '-' || {_hundredths("3500 + event_id % 3800")} END AS lon,
    CASE WHEN event_id % 29 = 0 THEN 'not-a-date'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS data_hora_gmt,
    CASE WHEN event_id % 43 = 0 THEN NULL
         WHEN event_type = 'click' THEN 'AQUA_M-T' ELSE event_type END AS satelite,
    'MUN_' || CAST(user_id AS VARCHAR) AS municipio,
    'UF_' || CAST(user_id % 27 AS VARCHAR) AS estado,
    'Brasil' AS pais,
    CAST(1100000 + user_id AS VARCHAR)
      || CASE WHEN event_id % 3 = 0 THEN '.0' ELSE '' END AS municipio_id,
    CASE WHEN event_id % 31 = 0 THEN 'UF' ELSE CAST(user_id % 27 AS VARCHAR) END AS estado_id,
    '33' AS pais_id,
    CASE WHEN event_id % 10 = 0 THEN NULL
         WHEN event_id % 9 = 0 THEN '-999'
         WHEN event_id % 37 = 0 THEN '40000'
         WHEN event_id % 21 = 0 THEN CAST(event_id % 120 AS VARCHAR) || '.0'
         ELSE CAST(event_id % 120 AS VARCHAR) END AS numero_dias_sem_chuva,
    CASE WHEN event_id % 8 = 0 THEN '-999'
         WHEN event_id % 19 = 0 THEN 'abc'
         WHEN event_id % 47 = 0 THEN 'NaN'
         WHEN event_id % 53 = 0 THEN 'Infinity'
         ELSE {_hundredths("event_id % 500")} END AS precipitacao,
    CASE WHEN user_id % 50 = 7 THEN NULL
         WHEN event_id % 59 = 0 THEN '-999.0'
         ELSE {_hundredths("event_id % 101")} END AS risco_fogo,
    CASE WHEN event_id % 17 <> 0 THEN 'BIOMA_' || CAST(event_id % 6 AS VARCHAR) END AS bioma,
    CASE WHEN event_id % 11 = 0 THEN NULL
         WHEN event_id % 7 = 0 THEN '-999'
         WHEN event_id % 13 = 0 THEN '-3.20'
         ELSE CAST(value AS VARCHAR) END AS frp,
    CAST(ts AS DATE) AS event_day,
    event_id % 23 = 0 AS published_late
  FROM events
)"""

_BRONZE = f"""bronze AS (
  SELECT *, CASE WHEN published_late THEN CAST(event_day + INTERVAL 1 DAY AS DATE)
                 ELSE event_day END AS extract_date
  FROM raw
)"""

# Landing every date of a month at once: a row lies under its own readable date, else under the
# latest date of its month file.
_LANDED = """bronze AS (
  SELECT *, CASE WHEN data_hora_gmt = 'not-a-date'
                 THEN max(event_day) OVER (PARTITION BY date_trunc('month', event_day))
                 ELSE event_day END AS extract_date
  FROM raw
)"""

# The whole month file under every date of that month between the table's first and last day.
_SNAPSHOT = """bronze AS (
  SELECT raw.*, CAST(day AS DATE) AS extract_date
  FROM raw JOIN (
    SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS day FROM events
  ) AS days ON date_trunc('month', day) = date_trunc('month', event_day)
)"""

_OF_DAY = """of_day AS (
  SELECT * FROM bronze WHERE CAST(TRY_CAST(data_hora_gmt AS TIMESTAMP) AS DATE) = extract_date
)"""


def _finite(column: str) -> str:
    return f"CASE WHEN isfinite(TRY_CAST({column} AS DOUBLE)) THEN TRY_CAST({column} AS DOUBLE) END"


def _cleaned(column: str) -> str:
    negative = f" OR ({_finite(column)}) < 0" if column == "frp" else ""
    return (
        f"CASE WHEN {column} IS NULL OR ({_finite(column)}) = -999{negative} THEN -999.0 "
        f"ELSE {_finite(column)} END"
    )


def _integer(column: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS INTEGER)"


_SILVER = f"""silver AS (
  SELECT
    id AS id_foco,
    TRY_CAST(data_hora_gmt AS TIMESTAMP) AS data_hora_gmt,
    strftime(extract_date, '%Y%m%d') AS "DATREF",
    CAST(year(TRY_CAST(data_hora_gmt AS TIMESTAMP)) AS SMALLINT) AS "ANO",
    CAST(month(TRY_CAST(data_hora_gmt AS TIMESTAMP)) AS SMALLINT) AS "MES",
    CAST(day(TRY_CAST(data_hora_gmt AS TIMESTAMP)) AS SMALLINT) AS "DIA",
    CAST(hour(TRY_CAST(data_hora_gmt AS TIMESTAMP)) AS SMALLINT) AS "HORA",
    CAST(minute(TRY_CAST(data_hora_gmt AS TIMESTAMP)) AS SMALLINT) AS "MINUTO",
    TRY_CAST(lat AS DOUBLE) AS lat,
    TRY_CAST(lon AS DOUBLE) AS lon,
    satelite, municipio, estado, pais,
    {_integer("municipio_id")} AS municipio_id,
    {_integer("estado_id")} AS estado_id,
    {_integer("pais_id")} AS pais_id,
    TRY_CAST(trunc({_cleaned("numero_dias_sem_chuva")}) AS SMALLINT) AS numero_dias_sem_chuva,
    {_cleaned("precipitacao")} AS precipitacao,
    {_cleaned("risco_fogo")} AS risco_fogo,
    bioma,
    {_cleaned("frp")} AS frp
  FROM of_day
)"""

_REFERENCE = "reference_rows AS (SELECT * FROM silver WHERE satelite = 'AQUA_M-T')"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_BASE = (_RAW, _BRONZE, _OF_DAY, _SILVER, _REFERENCE)
_CHAIN = (_RAW, _LANDED, _OF_DAY, _SILVER, _REFERENCE)
_EXTRACT = """strftime(extract_date, '%Y') AS extract_year,
    strftime(extract_date, '%m') AS extract_month,
    strftime(extract_date, '%d') AS extract_day"""


def _statistics() -> str:
    lines = []
    for column, label in METRIC_LABELS.items():
        filled = f"CASE WHEN {column} <> -999 THEN {column} ELSE 0 END"
        valid = f"count(CASE WHEN {column} <> -999 THEN 1 END)"
        for name in ("sum", "avg", "min", "max"):
            value = f"{name}({filled})"
            if column == "numero_dias_sem_chuva" and name != "avg":
                typed = f"CAST({value} AS {'BIGINT' if name == 'sum' else 'INTEGER'})"
            else:
                typed = f"CAST(round(CAST({value} AS DECIMAL(38,12)), 2) AS DOUBLE)"
            lines.append(f'CASE WHEN {valid} > 0 THEN {typed} END AS "{name.upper()}_{label}"')
    return ",\n  ".join(lines)


def gold_select(keys: tuple[str, ...], source: str = "reference_rows", version: str = "") -> str:
    named = "".join(f'{key} AS "{key.upper()}", ' for key in keys)
    group = ", ".join(['"DATREF"', *([version] if version else []), *keys])
    return f"""SELECT "DATREF", {named}count(id_foco) AS "QUANTIDADE_FOCO",
  {_statistics()}
FROM {source} GROUP BY {group}"""


def _chain_branch(table: str, keys: tuple[str, ...]) -> str:
    wanted = [
        f'"{key.upper()}"' if key in keys else f'CAST(NULL AS VARCHAR) AS "{key.upper()}"'
        for key in ("bioma", "estado", "municipio")
    ]
    measures = ['"QUANTIDADE_FOCO"'] + [
        f'"{name}_{label}"'
        for label in METRIC_LABELS.values()
        for name in ("SUM", "AVG", "MIN", "MAX")
    ]
    columns = ", ".join(wanted + measures)
    return f"""SELECT '{table}' AS "TABELA", "DATREF", {columns} FROM ({gold_select(keys)})"""


_SILVER_COLUMNS = """id_foco, data_hora_gmt, "DATREF", "ANO", "MES", "DIA", "HORA", "MINUTO", lat, lon, satelite,
    municipio, estado, pais, municipio_id, estado_id, pais_id, numero_dias_sem_chuva, precipitacao,
    risco_fogo, bioma, frp"""

_TWO_VERSIONS = """two_versions AS (
  SELECT *, 1 AS version FROM reference_rows
  UNION ALL
  SELECT * REPLACE (CASE WHEN frp <> -999 THEN frp + 1 ELSE frp END AS frp), 2 AS version
  FROM reference_rows
)"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    gold = {
        "foco_bioma": ("bioma",),
        "foco_estado": ("estado",),
        "foco_municipio": ("estado", "municipio"),
    }
    count_valid = ",\n  ".join(
        f'count(CASE WHEN {column} <> -999 THEN 1 END) AS "VALID_{label}"'
        for column, label in METRIC_LABELS.items()
    )
    split_date = """substr("DATREF", 1, 4) AS extract_year, substr("DATREF", 5, 2) AS extract_month,
    substr("DATREF", 7, 2) AS extract_day"""
    sql = {
        "bronze_scan": _with(_RAW) + f"SELECT {_RAW_COLUMNS} FROM raw",
        "bronze_landing": _with(_RAW, _LANDED) + f"SELECT {_RAW_COLUMNS},\n    {_EXTRACT} FROM bronze",
        "bronze_snapshot": _with(_RAW, _SNAPSHOT) + f"SELECT {_RAW_COLUMNS},\n    {_EXTRACT} FROM bronze",
        "bronze_mixed_headers": _with(_RAW, _LANDED)
        + f"""SELECT {_RAW_COLUMNS},
    {_EXTRACT},
    CASE WHEN event_day_number % 2 = 1 THEN 'N' || CAST(event_day_number AS VARCHAR) END AS nova
FROM (SELECT *, day(event_day) AS event_day_number FROM bronze)""",
        "chain_mixed_headers": _with(*_CHAIN) + f"SELECT {_SILVER_COLUMNS},\n    {split_date} FROM silver",
        "day_filter": _with(_RAW, _BRONZE, _OF_DAY)
        + f"SELECT {_RAW_COLUMNS},\n    {_EXTRACT} FROM of_day",
        "sentinel_clean": _with(_RAW, _BRONZE, _OF_DAY)
        + "SELECT id, data_hora_gmt,\n  "
        + ",\n  ".join(f"{_cleaned(c)} AS {c}" for c in METRIC_LABELS)
        + "\nFROM of_day",
        "silver_typed": _with(*_BASE) + f"SELECT {_SILVER_COLUMNS} FROM silver",
        "silver_lake": _with(*_CHAIN) + f"SELECT {_SILVER_COLUMNS},\n    {split_date} FROM silver",
        "reference_satellite": _with(*_BASE) + f"SELECT {_SILVER_COLUMNS} FROM reference_rows",
        "valid_counts": _with(*_BASE)
        + f"""SELECT "DATREF", bioma AS "BIOMA", estado AS "ESTADO", municipio AS "MUNICIPIO",
  count(id_foco) AS "QUANTIDADE_FOCO", count(*) AS "LINHAS",
  {count_valid}
FROM reference_rows GROUP BY "DATREF", bioma, estado, municipio""",
        "gold_two_versions": _with(*_BASE, _TWO_VERSIONS)
        + gold_select(("estado",), "two_versions", "version"),
        "daily_chain": _with(*_CHAIN)
        + "\nUNION ALL\n".join(_chain_branch(table, keys) for table, keys in gold.items()),
    }
    for table, keys in gold.items():
        sql[table.replace("foco", "gold")] = _with(*_BASE) + gold_select(keys)
    return sql
