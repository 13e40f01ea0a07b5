import datetime as dt
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

os.environ.setdefault("TZ", "UTC")

DAY = dt.date(2024, 10, 5)
VERSION = dt.datetime(2024, 10, 6, 13, 35)

# The published header.
HEADER = (
    "id,lat,lon,data_hora_gmt,satelite,municipio,estado,pais,municipio_id,estado_id,pais_id,"
    "numero_dias_sem_chuva,precipitacao,risco_fogo,bioma,frp"
)
# Golden rows: FIXTURES.md section 2.
ROWS = """\
f01,-3.20,-52.20,2024-10-05 00:00:00,AQUA_M-T,ALTAMIRA,PARÁ,Brasil,1500602,15,33,5,0.0,0.8,Amazônia,12.5
f02,-3.21,-52.21,2024-10-05 17:05:00,AQUA_M-T,ALTAMIRA,PARÁ,Brasil,1500602,15,33,-999,-999.0,-999.0,Amazônia,-3.2
f03,-6.64,-51.99,2024-10-05 23:59:59,AQUA_M-T,SÃO FÉLIX DO XINGU,PARÁ,Brasil,1507300,15,33,7,1.25,1.0,Amazônia,
f04,-19.0,-57.65,2024-10-05 04:10:00,AQUA_M-T,CORUMBÁ,MATO GROSSO DO SUL,Brasil,5003207,50,33,,,,Pantanal,
f05,-3.20,-52.20,2024-10-05 05:30:00,NOAA-20,ALTAMIRA,PARÁ,Brasil,1500602,15,33,5,0.0,0.9,Amazônia,99.9
f06,-3.20,-52.20,2024-10-04 23:59:59,AQUA_M-T,ALTAMIRA,PARÁ,Brasil,1500602,15,33,5,0.0,0.8,Amazônia,1.0
f07,-3.20,-52.20,2024-10-06 00:00:00,AQUA_M-T,ALTAMIRA,PARÁ,Brasil,1500602,15,33,5,0.0,0.8,Amazônia,1.0
f08,-12.0,-55.00,2024-10-05 16:45:10,AQUA_M-T,SINOP,MATO GROSSO,Brasil,5107909,51,33,3,abc,0.5,,0
f09,-12.0,-55.00,not-a-date,AQUA_M-T,SINOP,MATO GROSSO,Brasil,5107909,51,33,3,0.1,0.5,Cerrado,4.0
f10,-9.07,-44.36,2024-10-05 12:00:00,AQUA_M-T,BOM JESUS,PIAUÍ,Brasil,2201903,22,33,40000,2.5,0.7,Cerrado,8.25
f11,-28.66,-50.43,2024-10-05 12:01:00,AQUA_M-T,BOM JESUS,RIO GRANDE DO SUL,Brasil,4302303,43,33,0,10.0,0.0,Mata Atlântica,3.0
,-9.08,-44.37,2024-10-05 12:02:00,AQUA_M-T,BOM JESUS,PIAUÍ,Brasil,2201903,22,33,1,0.5,0.3,Cerrado,1.75
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def month_csv(tmp_path):
    """A monthly source folder with one file, and its path template."""
    folder = tmp_path / "source"
    folder.mkdir()
    (folder / "202410.csv").write_text(f"{HEADER}\n{ROWS}", encoding="utf-8")
    return str(folder / "{month}.csv")


@pytest.fixture
def raw(spark, month_csv):
    from emberlake.sources.bronze import month_path, read_raw

    return read_raw(spark, month_path(month_csv, DAY))


@pytest.fixture
def silver(raw):
    from emberlake.operators.silver import at_date, build_silver

    return build_silver(at_date(raw, DAY), VERSION)
