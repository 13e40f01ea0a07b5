"""One test per rule of the silver and gold layers that is easy to get wrong."""

import datetime as dt

import pytest
from conftest import DAY, VERSION

from pyspark.sql import functions as F

from emberlake.functions.measures import round_cents
from emberlake.operators.gold import (
    build_gold,
    finish_measures,
    merge_measures,
    partial_measures,
    reference_rows,
)
from emberlake.operators.silver import at_date, build_silver, clean_metrics, rows_of_day
from emberlake.schema import BRONZE_COLUMNS, GOLD_TABLES, SILVER_SCHEMA
from emberlake.sources.bronze import read_raw

BASE = {
    "id": "x",
    "lat": "-3.2",
    "lon": "-52.2",
    "data_hora_gmt": "2024-10-05 00:30:00",
    "satelite": "AQUA_M-T",
    "municipio": "M",
    "estado": "E",
    "pais": "Brasil",
    "municipio_id": "1500602",
    "estado_id": "15",
    "pais_id": "33",
    "numero_dias_sem_chuva": "1",
    "precipitacao": "1.0",
    "risco_fogo": "0.5",
    "bioma": "B",
    "frp": "2.0",
}


def bronze(spark, *changes, day=DAY):
    rows = [tuple({**BASE, **change}[c] for c in BRONZE_COLUMNS) for change in changes]
    schema = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)
    return at_date(spark.createDataFrame(rows, schema), day)


def silver_rows(spark, *changes, day=DAY):
    return build_silver(bronze(spark, *changes, day=day), VERSION).collect()


@pytest.mark.parametrize(
    ("column", "text", "value"),
    [
        ("frp", None, -999.0),
        ("frp", "-999", -999.0),
        ("frp", "-0.5", -999.0),
        ("frp", "-3.2", -999.0),
        ("frp", "0", 0.0),
        ("frp", "1e3", 1000.0),
        ("frp", "abc", None),
        ("frp", "NaN", None),
        ("frp", "Infinity", None),
        ("frp", "-Infinity", None),
        ("precipitacao", None, -999.0),
        ("precipitacao", "-999.0", -999.0),
        ("precipitacao", "-999.7", -999.7),
        ("precipitacao", "-1.5", -1.5),
        ("precipitacao", "0.57", 0.57),
        ("risco_fogo", None, -999.0),
        ("risco_fogo", "abc", None),
        ("numero_dias_sem_chuva", None, -999),
        ("numero_dias_sem_chuva", "-999", -999),
        ("numero_dias_sem_chuva", "12.0", 12),
        ("numero_dias_sem_chuva", "12.9", 12),
        ("numero_dias_sem_chuva", "32768", None),
        ("numero_dias_sem_chuva", "abc", None),
        ("municipio_id", "1500602.0", 1500602),
        ("municipio_id", "3000000000", None),
        ("estado_id", "UF", None),
        ("pais_id", None, None),
        ("lat", "abc", None),
        ("lon", " -52.5 ", -52.5),
    ],
)
def test_text_to_value(spark, column, text, value):
    (row,) = silver_rows(spark, {column: text})
    assert row[column] == value


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_session_ansi_setting_changes_nothing(spark, raw, ansi):
    expected = build_silver(at_date(raw, DAY), VERSION).collect()
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        frame = build_silver(at_date(raw.select("*"), DAY), VERSION)
        assert sorted(map(str, frame.collect())) == sorted(map(str, expected))
        assert build_gold(frame, ["bioma"], VERSION).count() == 5
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_wall_clock_ignores_session_zone_and_its_gaps(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # Midnight did not exist there on this day.
        (row,) = silver_rows(
            spark, {"data_hora_gmt": "2018-11-04 00:30:15"}, day=dt.date(2018, 11, 4)
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.data_hora_gmt == dt.datetime(2018, 11, 4, 0, 30, 15)
    assert (row.ANO, row.MES, row.DIA, row.HORA, row.MINUTO) == (2018, 11, 4, 0, 30)
    assert row.DATREF == "20181104"


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        ("2024-10-05 00:00:00", True),
        ("2024-10-05 23:59:59", True),
        ("2024-10-05", True),
        ("2024-10-04 23:59:59", False),
        ("2024-10-06 00:00:00", False),
        ("not-a-date", False),
        (None, False),
    ],
)
def test_day_filter(spark, text, kept):
    assert rows_of_day(bronze(spark, {"data_hora_gmt": text})).count() == kept


def test_many_dates_in_one_pass(spark):
    frame = bronze(spark, {"id": "a"}, {"id": "b", "data_hora_gmt": "2024-10-06 01:00:00"})
    next_day = {"data_hora_gmt": "2024-10-06 01:00:00"}
    both = frame.unionByName(
        bronze(spark, {"id": "c"}, {"id": "d", **next_day}, day=dt.date(2024, 10, 6))
    )
    kept = {(r.id_foco, r.DATREF) for r in build_silver(both, VERSION).collect()}
    assert kept == {("a", "20241005"), ("d", "20241006")}


def test_version_defaults_to_now(spark):
    before = dt.datetime.now()
    row = build_silver(bronze(spark, {})).first()
    assert before - dt.timedelta(minutes=1) < row.DATVER < before + dt.timedelta(minutes=5)
    assert [f.dataType for f in build_silver(bronze(spark, {})).schema] == [
        f.dataType for f in SILVER_SCHEMA
    ]


def test_metric_text_is_parsed_once(spark):
    frame = clean_metrics(rows_of_day(bronze(spark, {})))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(frp") == 1


def gold_row(spark, *changes):
    frame = build_silver(bronze(spark, *changes), VERSION)
    (row,) = build_gold(frame, ["bioma"], VERSION).collect()
    return row


def test_invalid_rows_are_zero_filled(spark):
    row = gold_row(spark, {"frp": "4.0"}, {"frp": None}, {"frp": "abc"}, {"frp": "6.0"})
    assert (row.SUM_FRP, row.AVG_FRP, row.MIN_FRP, row.MAX_FRP) == (10.0, 2.5, 0.0, 6.0)


def test_negative_maximum_is_zero_filled(spark):
    row = gold_row(spark, {"precipitacao": "-2.0"}, {"precipitacao": "-999"})
    assert (row.SUM_PRECIPITACAO, row.AVG_PRECIPITACAO) == (-2.0, -1.0)
    assert (row.MIN_PRECIPITACAO, row.MAX_PRECIPITACAO) == (-2.0, 0.0)


def test_no_valid_value_gives_null(spark):
    row = gold_row(spark, {"frp": None}, {"frp": "abc"})
    assert (row.SUM_FRP, row.AVG_FRP, row.MIN_FRP, row.MAX_FRP) == (None,) * 4
    assert row.QUANTIDADE_FOCO == 2


def test_count_skips_null_ids_but_metrics_do_not(spark):
    row = gold_row(spark, {"id": None, "frp": "5"}, {"frp": "1"})
    assert (row.QUANTIDADE_FOCO, row.SUM_FRP, row.AVG_FRP) == (1, 6.0, 3.0)


def test_only_the_reference_satellite(spark):
    frame = build_silver(
        bronze(spark, {}, {"satelite": "NOAA-20"}, {"satelite": None}, {"satelite": "aqua_m-t"}),
        VERSION,
    )
    assert reference_rows(frame).count() == 1
    assert reference_rows(frame, "NOAA-20").count() == 1


def test_two_versions_of_a_date_give_two_rows(spark):
    first = build_silver(bronze(spark, {"frp": "1"}), dt.datetime(2024, 10, 6))
    second = build_silver(bronze(spark, {"frp": "3"}), dt.datetime(2024, 10, 7))
    rows = build_gold(first.unionByName(second), ["bioma"], VERSION).collect()
    assert sorted(r.SUM_FRP for r in rows) == [1.0, 3.0]
    assert len({r.DATVER for r in rows}) == 1


@pytest.mark.parametrize(
    ("value", "rounded"),
    [
        (1.005, 1.01),
        (-1.005, -1.01),
        (2.675, 2.68),
        (0.1 + 0.2, 0.3),
        (4.1666666, 4.17),
        (None, None),
        (1.5e17, 1.5e17),
        (1e30, 1e30),
        (-1e30, -1e30),
    ],
)
def test_rounding(spark, value, rounded):
    frame = spark.createDataFrame([(value,)], "x double")
    assert frame.select(round_cents(F.col("x"))).first()[0] == rounded


@pytest.mark.parametrize("table", GOLD_TABLES)
def test_roll_up_equals_direct_aggregation(silver, table):
    keys = list(GOLD_TABLES[table])
    finest = partial_measures(reference_rows(silver), ["bioma", "estado", "municipio"])
    rolled = finish_measures(merge_measures(finest, keys), keys, VERSION)
    direct = build_gold(silver, keys, VERSION)
    assert rolled.dtypes == direct.dtypes
    assert sorted(map(str, rolled.collect())) == sorted(map(str, direct.collect()))


def test_columns_match_by_name_and_extras_are_dropped(spark, tmp_path):
    names = ["extra", *reversed(BRONZE_COLUMNS)]
    values = ["zzz", *(BASE[c] for c in reversed(BRONZE_COLUMNS))]
    header = ",".join(n.upper() if n == "frp" else n for n in names)
    (tmp_path / "a.csv").write_text(header + "\n" + ",".join(values) + "\n")
    frame = read_raw(spark, str(tmp_path / "a.csv"))
    assert frame.columns == list(BRONZE_COLUMNS)
    assert frame.first().asDict() == BASE
    assert {t for _, t in frame.dtypes} == {"string"}


def test_short_and_long_rows(spark, tmp_path):
    header = ",".join(BRONZE_COLUMNS)
    long = ",".join(BASE[c] for c in BRONZE_COLUMNS) + ",surplus"
    (tmp_path / "a.csv").write_text(f"{header}\nshort,1.0\n{long}\n")
    rows = {r.id: r for r in read_raw(spark, str(tmp_path / "a.csv")).collect()}
    assert (rows["short"].lat, rows["short"].lon, rows["short"].frp) == ("1.0", None, None)
    assert rows["x"].asDict() == BASE


def test_missing_column_is_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,lat\n1,2\n")
    with pytest.raises(ValueError, match="frp"):
        read_raw(spark, str(tmp_path / "a.csv"))
