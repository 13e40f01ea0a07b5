"""The silver and gold values of FIXTURES.md sections 3 and 4."""

import datetime as dt

import pytest
from conftest import DAY, VERSION

from emberlake.operators.gold import build_gold, most_first
from emberlake.schema import GOLD_TABLES, SILVER_SCHEMA, gold_schema

NONE4 = (None,) * 4
AMAZONIA = (3, (12.5, 4.17, 0.0, 12.5), (12, 4.0, 0, 7), (1.25, 0.42, 0.0, 1.25), (1.8, 0.6, 0.0, 1.0))
CERRADO = (1, (10.0, 5.0, 1.75, 8.25), (1, 0.5, 0, 1), (3.0, 1.5, 0.5, 2.5), (1.0, 0.5, 0.3, 0.7))
MATA = (1, (3.0,) * 4, (0, 0.0, 0, 0), (10.0,) * 4, (0.0,) * 4)
PANTANAL = (1, NONE4, NONE4, NONE4, NONE4)
NO_BIOME = (1, (0.0,) * 4, (3, 3.0, 3, 3), NONE4, (0.5,) * 4)

GOLD = {
    "foco_bioma": {
        ("Amazônia",): AMAZONIA,
        ("Cerrado",): CERRADO,
        ("Mata Atlântica",): MATA,
        ("Pantanal",): PANTANAL,
        (None,): NO_BIOME,
    },
    "foco_estado": {
        ("PARÁ",): AMAZONIA,
        ("PIAUÍ",): CERRADO,
        ("RIO GRANDE DO SUL",): MATA,
        ("MATO GROSSO DO SUL",): PANTANAL,
        ("MATO GROSSO",): NO_BIOME,
    },
    "foco_municipio": {
        ("PARÁ", "ALTAMIRA"): (
            2,
            (12.5, 6.25, 0.0, 12.5),
            (5, 2.5, 0, 5),
            (0.0,) * 4,
            (0.8, 0.4, 0.0, 0.8),
        ),
        ("PARÁ", "SÃO FÉLIX DO XINGU"): (1, NONE4, (7, 7.0, 7, 7), (1.25,) * 4, (1.0,) * 4),
        ("PIAUÍ", "BOM JESUS"): CERRADO,
        ("RIO GRANDE DO SUL", "BOM JESUS"): MATA,
        ("MATO GROSSO DO SUL", "CORUMBÁ"): PANTANAL,
        ("MATO GROSSO", "SINOP"): NO_BIOME,
    },
}


def as_table(rows, n_keys):
    out = {}
    for row in rows:
        values = list(row)[2:]
        keys, count, stats = values[:n_keys], values[n_keys], values[n_keys + 1 :]
        assert tuple(keys) not in out
        out[tuple(keys)] = (count, *(tuple(stats[i : i + 4]) for i in range(0, 16, 4)))
    return out


def test_silver(silver):
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in SILVER_SCHEMA
    ]
    got = {
        (
            r.id_foco,
            f"{r.data_hora_gmt:%H:%M:%S}",
            r.satelite,
            r.frp,
            r.numero_dias_sem_chuva,
            r.precipitacao,
            r.risco_fogo,
        )
        for r in silver.collect()
    }
    assert got == {
        ("f01", "00:00:00", "AQUA_M-T", 12.5, 5, 0.0, 0.8),
        ("f02", "17:05:00", "AQUA_M-T", -999.0, -999, -999.0, -999.0),
        ("f03", "23:59:59", "AQUA_M-T", -999.0, 7, 1.25, 1.0),
        ("f04", "04:10:00", "AQUA_M-T", -999.0, -999, -999.0, -999.0),
        ("f05", "05:30:00", "NOAA-20", 99.9, 5, 0.0, 0.9),
        ("f08", "16:45:10", "AQUA_M-T", 0.0, 3, None, 0.5),
        ("f10", "12:00:00", "AQUA_M-T", 8.25, None, 2.5, 0.7),
        ("f11", "12:01:00", "AQUA_M-T", 3.0, 0, 10.0, 0.0),
        (None, "12:02:00", "AQUA_M-T", 1.75, 1, 0.5, 0.3),
    }


def test_silver_row_whole(silver):
    row = silver.where("id_foco = 'f02'").drop("DATVER").first()
    assert tuple(row) == (
        "f02",
        dt.datetime(2024, 10, 5, 17, 5),
        "20241005",
        2024,
        10,
        5,
        17,
        5,
        -3.21,
        -52.21,
        "AQUA_M-T",
        "ALTAMIRA",
        "PARÁ",
        "Brasil",
        1500602,
        15,
        33,
        -999,
        -999.0,
        -999.0,
        "Amazônia",
        -999.0,
    )


@pytest.mark.parametrize("table", GOLD_TABLES)
def test_gold(silver, table):
    keys = GOLD_TABLES[table]
    gold = most_first(build_gold(silver, keys, VERSION))
    assert [(f.name, f.dataType) for f in gold.schema] == [
        (f.name, f.dataType) for f in gold_schema(keys)
    ]
    rows = gold.collect()
    assert as_table(rows, len(keys)) == GOLD[table]
    assert {r.DATREF for r in rows} == {f"{DAY:%Y%m%d}"}
    counts = [r.QUANTIDADE_FOCO for r in rows]
    assert counts == sorted(counts, reverse=True)
