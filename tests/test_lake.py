"""Layout of the lake, replacing dates, and the jobs over it."""

import datetime as dt
import glob
import gzip
import shutil
from pathlib import Path

import pytest
from conftest import DAY, HEADER, ROWS, VERSION
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from emberlake import __main__ as cli
from emberlake.plans import jobs
from emberlake.schema import BRONZE_COLUMNS, GOLD_TABLES
from emberlake.sources import lake as lake_module
from emberlake.sources.bronze import read_bronze, read_raw
from emberlake.sources.files import first_line
from emberlake.sources.lake import Lake, date_leaf, write_dates
from test_golden import GOLD, as_table

DAY4, DAY6 = dt.date(2024, 10, 4), dt.date(2024, 10, 6)
LATER = dt.datetime(2024, 10, 7, 13, 35)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def files(leaf, suffix):
    return sorted(glob.glob(f"{leaf}/*.{suffix}"))


def gold_of(spark, lake, table, dates):
    keys = len(GOLD_TABLES[table])
    extracts = ("extract_year", "extract_month", "extract_day")
    return as_table(jobs.read_gold(spark, lake, table, dates).drop(*extracts).collect(), keys)


def test_daily_chain(spark, lake, month_csv):
    jobs.daily_chain(spark, lake, month_csv, [DAY], VERSION)
    assert read_bronze(spark, lake.bronze, [DAY]).count() == 12
    assert jobs.read_silver(spark, lake, [DAY]).count() == 9
    for table in GOLD_TABLES:
        assert gold_of(spark, lake, table, [DAY]) == GOLD[table]
    leaf = date_leaf(lake.silver, DAY)
    assert leaf.endswith("/extract_year=2024/extract_month=10/extract_day=05")
    assert len(files(leaf, "parquet")) == 1
    assert len(files(date_leaf(lake.gold("foco_municipio"), DAY), "parquet")) == 1


def test_leaf_reads_on_its_own(spark, lake, month_csv):
    """A leaf holds exactly the documented columns, in order."""
    jobs.daily_chain(spark, lake, month_csv, [DAY], VERSION)
    silver = spark.read.parquet(date_leaf(lake.silver, DAY))
    assert silver.columns == jobs.SILVER_SCHEMA.names
    gold = spark.read.parquet(date_leaf(lake.gold("foco_estado"), DAY))
    assert gold.columns == jobs.gold_schema(("estado",)).names
    bronze = spark.read.csv(date_leaf(lake.bronze, DAY), header=True)
    assert bronze.columns == list(BRONZE_COLUMNS)


def test_partition_text_stays_zero_padded(spark, lake, month_csv):
    jobs.daily_chain(spark, lake, month_csv, [DAY], VERSION)
    row = jobs.read_silver(spark, lake).first()
    assert (row.extract_year, row.extract_month, row.extract_day) == ("2024", "10", "05")


def test_files_are_sorted(spark, lake, month_csv):
    jobs.daily_chain(spark, lake, month_csv, [DAY], VERSION)
    silver = spark.read.parquet(*files(date_leaf(lake.silver, DAY), "parquet"))
    satellites = [r.satelite for r in silver.collect()]
    assert satellites == sorted(satellites)
    gold = spark.read.parquet(*files(date_leaf(lake.gold("foco_bioma"), DAY), "parquet"))
    counts = [r.QUANTIDADE_FOCO for r in gold.collect()]
    assert counts == sorted(counts, reverse=True)


def test_many_dates_equal_single_runs(spark, tmp_path, month_csv):
    together, apart = Lake(str(tmp_path / "together")), Lake(str(tmp_path / "apart"))
    dates = [DAY4, DAY, DAY6]
    jobs.daily_chain(spark, together, month_csv, dates, VERSION)
    for date in dates:
        jobs.daily_chain(spark, apart, month_csv, [date], VERSION)

    def rows(frame):
        return sorted(map(str, frame.collect()))

    assert rows(jobs.read_silver(spark, together)) == rows(jobs.read_silver(spark, apart))
    for table in GOLD_TABLES:
        assert rows(jobs.read_gold(spark, together, table)) == rows(
            jobs.read_gold(spark, apart, table)
        )
    # Bronze holds the same, whether dates are landed together or one by one.
    assert read_bronze(spark, together.bronze, dates).count() == 36
    assert rows(read_bronze(spark, together.bronze, dates)) == rows(read_bronze(spark, apart.bronze, dates))


def test_layouts_differ_in_bronze_only(spark, tmp_path, month_csv):
    whole, once = Lake(str(tmp_path / "whole")), Lake(str(tmp_path / "once"))
    dates = [DAY4, DAY, DAY6]
    jobs.daily_chain(spark, whole, month_csv, dates, VERSION)
    jobs.daily_chain(spark, once, month_csv, dates, VERSION, layout="by_date")
    landed = read_bronze(spark, once.bronze, dates)
    assert landed.count() == 12
    assert landed.where("id = 'f09'").first().extract_day == "06"  # the unreadable one, under the latest
    for table in GOLD_TABLES:
        assert sorted(map(str, jobs.read_gold(spark, once, table).collect())) == sorted(
            map(str, jobs.read_gold(spark, whole, table).collect())
        )
    with pytest.raises(ValueError, match="layout"):
        jobs.bronze_job(spark, once, month_csv, dates, "other")


def test_backfill_by_date_shuffles_once(spark, lake, month_csv):
    jobs.bronze_job(spark, lake, month_csv, [DAY4, DAY], "by_date")
    plan = plan_of(jobs.build_silver(read_bronze(spark, lake.bronze, [DAY4, DAY])))
    assert "Exchange" not in plan


def test_rerun_replaces_only_its_dates(spark, lake, month_csv):
    jobs.daily_chain(spark, lake, month_csv, [DAY4, DAY], VERSION)
    before = files(date_leaf(lake.silver, DAY4), "parquet")
    path = Path(month_csv.replace("{month}", "202410"))
    path.write_text(path.read_text(encoding="utf-8").replace(",12.5\n", ",13.5\n"), encoding="utf-8")
    jobs.daily_chain(spark, lake, month_csv, [DAY], LATER)
    assert files(date_leaf(lake.silver, DAY4), "parquet") == before
    rows = jobs.read_silver(spark, lake, [DAY]).collect()
    assert len(rows) == 9
    assert {r.DATVER for r in rows} == {LATER}
    assert gold_of(spark, lake, "foco_bioma", [DAY])[("Amazônia",)][1][0] == 13.5


@pytest.mark.parametrize("dates", [[DAY], [DAY4, DAY]])
def test_emptied_date_is_cleared(spark, lake, month_csv, dates):
    jobs.daily_chain(spark, lake, month_csv, dates, VERSION)
    kept = [line for line in ROWS.splitlines() if "2024-10-05" not in line]
    path = Path(month_csv.replace("{month}", "202410"))
    path.write_text("\n".join([HEADER, *kept]) + "\n", encoding="utf-8")
    jobs.daily_chain(spark, lake, month_csv, dates, VERSION)
    assert jobs.read_silver(spark, lake, [DAY]).count() == 0
    assert len(files(date_leaf(lake.silver, DAY), "parquet")) == 1
    for table in GOLD_TABLES:
        assert jobs.read_gold(spark, lake, table, [DAY]).count() == 0
        assert spark.read.parquet(date_leaf(lake.gold(table), DAY)).count() == 0
    if len(dates) > 1:
        assert jobs.read_silver(spark, lake, [DAY4]).count() == 1


def test_empty_source_lands_an_empty_date(spark, lake, tmp_path):
    (tmp_path / "202410.csv").write_text(HEADER + "\n")
    jobs.daily_chain(spark, lake, str(tmp_path / "{month}.csv"), [DAY], VERSION)
    assert read_bronze(spark, lake.bronze, [DAY]).count() == 0
    assert jobs.read_gold(spark, lake, "foco_bioma", [DAY]).count() == 0


def test_dates_over_several_months(spark, lake, tmp_path):
    november = ROWS.splitlines()[0].replace("2024-10-05", "2024-11-02")
    (tmp_path / "202410.csv").write_text(f"{HEADER}\n{ROWS}", encoding="utf-8")
    turned = ",".join(reversed(HEADER.split(",")))
    flipped = ",".join(reversed(november.split(",")))
    (tmp_path / "202411.csv").write_text(f"{turned}\n{flipped}\n", encoding="utf-8")
    dates = [DAY, dt.date(2024, 11, 2)]
    jobs.daily_chain(spark, lake, str(tmp_path / "{month}.csv"), dates, VERSION)
    counts = {r.DATREF: r["count"] for r in jobs.read_silver(spark, lake).groupBy("DATREF").count().collect()}
    assert counts == {"20241005": 9, "20241102": 1}


def test_landed_values_are_unchanged(spark, lake, tmp_path):
    odd = ['"SÃO ""X"""', "  padded  ", '""', "a\\b", "'q'", "MATO; GROSSO", '"com, vírgula"']
    lines = []
    for i, name in enumerate(odd):
        row = dict.fromkeys(BRONZE_COLUMNS, "")
        row |= {"id": str(i), "municipio": name, "frp": "1.50", "data_hora_gmt": f"{DAY} 01:00:00"}
        lines.append(",".join(row[c] for c in HEADER.split(",")))
    (tmp_path / "202410.csv").write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    source = str(tmp_path / "{month}.csv")
    jobs.bronze_job(spark, lake, source, [DAY])
    raw = read_raw(spark, str(tmp_path / "202410.csv"))
    landed = read_bronze(spark, lake.bronze, [DAY]).select(*BRONZE_COLUMNS)
    assert sorted(map(tuple, landed.collect()), key=str) == sorted(map(tuple, raw.collect()), key=str)
    assert landed.where("id = '1'").first().municipio == "  padded  "


def test_files_are_matched_by_their_own_header(spark, lake, tmp_path):
    """One folder, two header orders, one file with a column more: no value changes its column."""
    folder = tmp_path / "202410"
    folder.mkdir()
    names = HEADER.split(",")
    lines = [line.split(",") for line in ROWS.splitlines()]
    turned = ["nova", *reversed(names)]
    (folder / "a.csv").write_text("\n".join([HEADER, *(",".join(x) for x in lines[:6])]) + "\n", encoding="utf-8")
    other = [",".join(["extra", *reversed(x)]) for x in lines[6:]]
    (folder / "b.csv").write_text("\n".join([",".join(turned), *other]) + "\n", encoding="utf-8")
    jobs.daily_chain(spark, lake, str(tmp_path / "{month}"), [DAY], VERSION)
    for table in GOLD_TABLES:
        assert gold_of(spark, lake, table, [DAY]) == GOLD[table]
    landed = read_bronze(spark, lake.bronze, [DAY], all_columns=True)
    assert {r.nova for r in landed.collect()} == {None, "extra"}
    assert landed.where("nova = 'extra'").count() == 6
    assert "nova" not in read_bronze(spark, lake.bronze, [DAY]).columns


def test_bronze_dates_with_other_headers_are_united(spark, lake):
    for date, columns in ((DAY4, BRONZE_COLUMNS), (DAY, tuple(reversed(BRONZE_COLUMNS)))):
        leaf = Path(date_leaf(lake.bronze, date))
        leaf.mkdir(parents=True)
        (leaf / "table.csv").write_text(f"{','.join(columns)}\n{','.join(columns)}\n")
    rows = read_bronze(spark, lake.bronze, [DAY4, DAY]).select(*BRONZE_COLUMNS).collect()
    assert [tuple(r) for r in rows] == [BRONZE_COLUMNS] * 2


def test_missing_columns_are_named(spark, lake, tmp_path):
    (tmp_path / "202410.csv").write_text("id,lat\n1,2\n")
    with pytest.raises(ValueError, match="lacks the columns lon"):
        jobs.bronze_job(spark, lake, str(tmp_path / "{month}.csv"), [DAY])


ZONE = "America/Sao_Paulo"


def write_instants(spark, lake, date, kind="INT96"):
    """A silver date of a writer that took 22:30 for local time and stored the instant."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.parquet.outputTimestampType", kind)
    spark.conf.set("spark.sql.session.timeZone", ZONE)
    try:
        row = spark.range(1).select(
            *(
                F.lit(f"{date} 22:30:00").cast("timestamp").alias(f.name) if f.name == "data_hora_gmt"
                else F.lit("old").alias(f.name) if f.name == "id_foco"
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in jobs.SILVER_SCHEMA
            )
        )
        row.write.parquet(date_leaf(lake.silver, date))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.conf.unset("spark.sql.parquet.outputTimestampType")


@pytest.mark.parametrize("kind", ["INT96", "TIMESTAMP_MICROS", "TIMESTAMP_MILLIS"])
def test_existing_lake_with_zoned_times(spark, tmp_path, kind):
    lake = Lake(str(tmp_path), silver_path="silver/old")
    write_instants(spark, lake, DAY, kind)
    assert jobs.read_silver(spark, lake, [DAY], ZONE).first().data_hora_gmt == dt.datetime(2024, 10, 5, 22, 30)
    assert jobs.read_silver(spark, lake, None, ZONE).first().data_hora_gmt == dt.datetime(2024, 10, 5, 22, 30)
    with pytest.raises(ValueError, match="source_zone"):
        jobs.read_silver(spark, lake, [DAY])
    with pytest.raises(ValueError, match="source_zone"):
        jobs.gold_job(spark, lake, [DAY])
    jobs.gold_job(spark, lake, [DAY], source_zone=ZONE)
    assert jobs.read_gold(spark, lake, "foco_bioma", [DAY]).count() == 0


def test_dates_of_two_writers(spark, lake, month_csv):
    """Instants of one date are turned back, the times of another stay."""
    jobs.daily_chain(spark, lake, month_csv, [DAY], VERSION)
    plain = sorted(map(str, jobs.read_silver(spark, lake, [DAY]).collect()))
    write_instants(spark, lake, DAY4)
    with pytest.raises(ValueError, match="source_zone"):
        jobs.read_silver(spark, lake, [DAY4, DAY])
    both = jobs.read_silver(spark, lake, [DAY4, DAY], ZONE)
    assert sorted(map(str, both.where("id_foco IS NULL OR id_foco <> 'old'").collect())) == plain
    assert both.where("id_foco = 'old'").first().data_hora_gmt == dt.datetime(2024, 10, 4, 22, 30)
    cli.main(["--root", lake.root, "--step", "gold", "--date", "20241004", "--until", "20241005", "--source-zone", ZONE])
    assert gold_of(spark, lake, "foco_bioma", [DAY]) == GOLD["foco_bioma"]


def test_empty_dates_take_a_constant_number_of_jobs(spark, tmp_path, month_csv):
    def jobs_for(days):
        lake = Lake(str(tmp_path / f"lake{days}"))
        group = f"empty-{days}"
        spark.sparkContext.setJobGroup(group, group)
        jobs.bronze_job(spark, lake, month_csv, [dt.date(2024, 10, 1) + dt.timedelta(days=n) for n in range(days)], "by_date")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        dates = [dt.date(2024, 10, 1) + dt.timedelta(days=n) for n in range(days)]
        assert read_bronze(spark, lake.bronze, dates).count() == 12
        return found

    assert jobs_for(31) <= jobs_for(8) + 1


def bytes_read(spark):
    return spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead")


def test_first_lines_are_read_alone(spark, tmp_path):
    """The bytes read do not depend on the size of a file."""
    read = {}
    for name, rows in (("small", 1_000), ("large", 400_000)):
        path = tmp_path / f"{name}.csv"
        path.write_text(f"\n  \n{HEADER}\n" + (ROWS.splitlines()[0] + "\n") * rows, encoding="utf-8")
        before = bytes_read(spark)
        assert first_line(spark, path.as_uri()) == HEADER
        read[name] = bytes_read(spark) - before
    assert (tmp_path / "large.csv").stat().st_size > 40_000_000
    assert 0 < read["small"] <= 64 * 1024 and read["large"] <= read["small"]


def test_first_lines_of_odd_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text(" \n\n")
    (tmp_path / "alone.csv").write_text("a,b")
    (tmp_path / "r.csv").write_bytes(b"a,\xc3\xa3\r\n1,2\r\n")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as file:
        file.write("x,y\n1,2\n")
    names = ["empty.csv", "blank.csv", "alone.csv", "r.csv", "packed.csv.gz"]
    found = [first_line(spark, (tmp_path / n).as_uri()) for n in names]
    assert found == [None, None, "a,b", "a,\u00e3", "x,y"]


def test_files_with_blanks_in_their_names(spark, lake, tmp_path):
    folder = tmp_path / "mês de 202410"
    folder.mkdir()
    (folder / "focos a%20b.csv").write_text(f"{HEADER}\n{ROWS}", encoding="utf-8")
    with gzip.open(folder / "mais.csv.gz", "wt", encoding="utf-8") as file:
        file.write(f"{HEADER}\n{ROWS.splitlines()[0]}\n")
    jobs.bronze_job(spark, lake, str(tmp_path / "mês de {month}"), [DAY])
    assert read_bronze(spark, lake.bronze, [DAY]).count() == 13


def jobs_started(spark, name, call):
    """The jobs of ``call``. Spark lists more than 32 paths by a job; here it need not."""
    key = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    spark.conf.set(key, "100000")
    spark.sparkContext.setJobGroup(name, name)
    try:
        call()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset(key)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


@pytest.mark.parametrize("layout", ["snapshot", "by_date"])
def test_many_months_start_as_many_jobs_as_one(spark, tmp_path, layout):
    source = tmp_path / "raw"
    source.mkdir()
    months = [dt.date(2015 + n // 12, 1 + n % 12, 3) for n in range(120)]
    names = HEADER.split(",")
    for date in months:
        row = dict(zip(names, ROWS.splitlines()[0].split(","))) | {"data_hora_gmt": f"{date} 01:02:03", "id": f"{date:%Y%m}"}
        (source / f"{date:%Y%m}.csv").write_text(f"{HEADER}\n{','.join(row.values())}\n", encoding="utf-8")

    def landed(days):
        lake = Lake(str(tmp_path / f"lake{len(days)}"))
        made = jobs_started(
            spark, f"land-{layout}-{len(days)}", lambda: jobs.bronze_job(spark, lake, f"{source}/{{month}}.csv", days, layout)
        )
        rows = read_bronze(spark, lake.bronze, days).collect()
        assert sorted((r.id, r.extract_year + r.extract_month + r.extract_day) for r in rows) == [
            (f"{d:%Y%m}", f"{d:%Y%m%d}") for d in days
        ]
        return made

    assert landed(months) == landed(months[:1])


def test_a_file_lands_under_the_dates_of_its_month(spark, lake, tmp_path):
    """In both layouts, whatever else the call asks for; headers of the months differ."""
    turned = ",".join(reversed(HEADER.split(",")))
    november = ",".join(reversed(ROWS.splitlines()[0].replace("2024-10-05", "2024-11-02").split(",")))
    (tmp_path / "202410.csv").write_text(f"{HEADER}\n{ROWS}", encoding="utf-8")
    (tmp_path / "202411.csv").write_text(f"{turned}\n{november}\n", encoding="utf-8")
    dates = [DAY4, DAY, dt.date(2024, 11, 1), dt.date(2024, 11, 2)]
    counts = {}
    for layout in ("snapshot", "by_date"):
        jobs.bronze_job(spark, lake, str(tmp_path / "{month}.csv"), dates, layout)
        rows = read_bronze(spark, lake.bronze, dates).groupBy("extract_month", "extract_day").count().collect()
        counts[layout] = {r.extract_month + r.extract_day: r["count"] for r in rows}
    assert counts["snapshot"] == {"1004": 12, "1005": 12, "1101": 1, "1102": 1}
    assert counts["by_date"] == {"1004": 1, "1005": 11, "1102": 1}


def shuffle_files(spark):
    """The shuffle files that the session holds now, and their bytes."""
    folders = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {f: f.stat().st_size for folder in folders for f in Path(folder.getPath()).glob("*/shuffle_*.data")}


def test_a_snapshot_is_shuffled_once_and_lands_compressed(spark, lake, tmp_path):
    """Whatever the number of its dates, each of which holds all rows."""
    names = HEADER.split(",")
    row = dict(zip(names, ROWS.splitlines()[0].split(",")))
    lines = [",".join((row | {"id": f"{n}", "lat": f"-{n * 7919 % 3300 / 100}"}).values()) for n in range(20_000)]
    source = tmp_path / "202410.csv"
    source.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    written = {}
    for days in (1, 31):
        before = shuffle_files(spark)
        dates = [dt.date(2024, 10, 1 + n) for n in range(days)]
        jobs.bronze_job(spark, lake, str(tmp_path / "{month}.csv"), dates)
        written[days] = sum(size for file, size in shuffle_files(spark).items() if file not in before)
    assert 0 < written[31] <= 2 * written[1]
    landed = read_bronze(spark, lake.bronze, dates).groupBy("extract_day")
    counts = landed.agg(F.count("*").alias("n"), F.countDistinct("id", "lat").alias("k")).collect()
    assert sorted((r.extract_day, r.n, r.k) for r in counts) == [(f"{n:02}", 20_000, 20_000) for n in range(1, 32)]
    size = sum(f.stat().st_size for f in Path(lake.bronze).rglob("part-*"))
    assert size < 31 * source.stat().st_size / 3


def test_the_dates_of_a_snapshot_stay_out_of_its_shuffle_and_its_files_are_small(spark, lake, tmp_path):
    """Files of two months, one with more dates than the other, of rows that a fast compressor leaves large."""
    names = HEADER.split(",")
    row = dict(zip(names, ROWS.splitlines()[0].split(",")))
    texts = {}
    for month in ("202410", "202411"):
        own = [{"id": f"{month}{n}", "lat": f"-{n * 7919 % 3300 / 100}", "frp": f"{n * n % 9973 / 10}"} for n in range(20_000)]
        texts[month] = "\n".join([HEADER, *(",".join((row | some).values()) for some in own)]) + "\n"
        (tmp_path / f"{month}.csv").write_text(texts[month], encoding="utf-8")
    written = {}
    for days in (1, 30):
        before = shuffle_files(spark)
        dates = [dt.date(2024, 10, 1 + n) for n in range(days)] + [dt.date(2024, 11, 1)]
        jobs.bronze_job(spark, lake, str(tmp_path / "{month}.csv"), dates)
        written[days] = sum(size for file, size in shuffle_files(spark).items() if file not in before)
    assert 0 < written[30] <= 1.01 * written[1]
    ids = read_bronze(spark, lake.bronze, dates).withColumn("month", F.substring("id", 1, 6))
    counts = ids.groupBy("extract_month", "extract_day", "month").agg(F.count("*").alias("n"), F.countDistinct("id").alias("k")).collect()
    whole = [("10", f"{n:02}", "202410", 20_000, 20_000) for n in range(1, 31)] + [("11", "01", "202411", 20_000, 20_000)]
    assert sorted(map(tuple, counts)) == whole
    landed = sum(f.stat().st_size for f in Path(lake.bronze).rglob("part-*"))
    packed = {month: len(gzip.compress(text.encode(), 5)) for month, text in texts.items()}
    assert landed <= 1.04 * (30 * packed["202410"] + packed["202411"])


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_file_for_more_dates_than_a_month_has(spark, lake, month_csv, adaptive):
    """A source without a month in its path is for all dates."""
    dates = [DAY + dt.timedelta(days=n) for n in range(70)]
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        jobs.bronze_job(spark, lake, month_csv.replace("{month}", "202410"), dates)
        rows = read_bronze(spark, lake.bronze, dates).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found = {}
    for r in rows:
        found.setdefault(f"{r.extract_year}{r.extract_month}{r.extract_day}", []).append(tuple(r[c] for c in BRONZE_COLUMNS))
    whole = sorted(map(tuple, read_raw(spark, month_csv.replace("{month}", "202410")).collect()), key=str)
    assert {day: sorted(some, key=str) for day, some in found.items()} == {f"{d:%Y%m%d}": whole for d in dates}


def emptied(spark, lake, month_csv):
    """A lake of two dates whose source then loses the second."""
    jobs.daily_chain(spark, lake, month_csv, [DAY4, DAY], VERSION)
    kept = [line for line in ROWS.splitlines() if "2024-10-05" not in line]
    Path(month_csv.replace("{month}", "202410")).write_text("\n".join([HEADER, *kept]) + "\n", encoding="utf-8")
    jobs.bronze_job(spark, lake, month_csv, [DAY4, DAY])


@pytest.mark.parametrize("step", ["_copy_to_leaves", "_swap_in"])
def test_driver_lost_before_the_commit_leaves_every_date(spark, lake, month_csv, monkeypatch, step):
    emptied(spark, lake, month_csv)
    before = [files(date_leaf(lake.silver, d), "parquet") for d in (DAY4, DAY)]

    def lost(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(lake_module, step, lost)
    with pytest.raises(KeyboardInterrupt):
        jobs.silver_job(spark, lake, [DAY4, DAY], LATER)
    assert [files(date_leaf(lake.silver, d), "parquet") for d in (DAY4, DAY)] == before


def test_driver_lost_after_the_commit_leaves_no_stale_date(spark, lake, month_csv, monkeypatch):
    emptied(spark, lake, month_csv)
    plain = lake_module._swap_in

    def lost(*args):
        plain(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(lake_module, "_swap_in", lost)
    with pytest.raises(KeyboardInterrupt):
        jobs.silver_job(spark, lake, [DAY4, DAY], LATER)
    assert jobs.read_silver(spark, lake, [DAY]).count() == 0
    assert {r.DATVER for r in jobs.read_silver(spark, lake, [DAY4]).collect()} == {LATER}
    assert not glob.glob(f"{lake.silver}/_*")


def test_an_abandoned_staging_folder_is_not_read(spark, lake, month_csv):
    jobs.daily_chain(spark, lake, month_csv, [DAY], VERSION)
    left = Path(lake.silver) / "_staging-left" / Path(date_leaf(".", DAY))
    left.parent.mkdir(parents=True)
    shutil.copytree(date_leaf(lake.silver, DAY), left)
    assert jobs.read_silver(spark, lake).count() == 9


def test_unwritten_date_raises(spark, lake, month_csv):
    with pytest.raises(AnalysisException):
        jobs.silver_job(spark, lake, [DAY])
    jobs.daily_chain(spark, lake, month_csv, [DAY], VERSION)
    with pytest.raises(AnalysisException):
        jobs.gold_job(spark, lake, [DAY6])


def test_failed_write_keeps_the_old_date(spark, lake, month_csv):
    jobs.daily_chain(spark, lake, month_csv, [DAY], VERSION)
    silver = jobs.read_silver(spark, lake, [DAY]).select(*jobs.SILVER_SCHEMA.names)
    before = files(date_leaf(lake.silver, DAY), "parquet")
    broken = silver.withColumn("frp", F.when(F.col("id_foco") == "f11", F.raise_error("no")).otherwise(1.0))
    with pytest.raises(Exception, match="no"):
        write_dates(broken, lake.silver, [DAY])
    assert files(date_leaf(lake.silver, DAY), "parquet") == before


def test_one_gold_table_at_a_time(spark, lake, month_csv):
    jobs.bronze_job(spark, lake, month_csv, [DAY])
    jobs.silver_job(spark, lake, [DAY], VERSION, compact=False)
    for table in GOLD_TABLES:
        jobs.gold_job(spark, lake, [DAY], [table], VERSION)
        assert gold_of(spark, lake, table, [DAY]) == GOLD[table]


@pytest.mark.parametrize("partitions", [8, 2400, 8000])
def test_large_date_is_split_and_small_dates_are_not(spark, lake, partitions):
    """One date holds most rows: it is written by several tasks, the others stay one file each."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m", "spark.sql.shuffle.partitions": partitions}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        write_dates(three_dates(spark), lake.silver, [DAY4, DAY, DAY6])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(files(date_leaf(lake.silver, DAY), "parquet")) >= 4
    assert len(files(date_leaf(lake.silver, DAY4), "parquet")) == 1
    assert len(files(date_leaf(lake.silver, DAY6), "parquet")) == 1
    assert spark.read.parquet(lake.silver).count() == 200_000


def test_large_date_is_split_without_adaptive_execution(spark, lake):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_dates(three_dates(spark), lake.silver, [DAY4, DAY, DAY6])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 4 <= len(files(date_leaf(lake.silver, DAY), "parquet")) <= 8
    assert spark.read.parquet(lake.silver).count() == 200_000


def three_dates(spark):
    return spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 == 0, "20241004")
        .when(F.col("id") % 10 == 1, "20241006")
        .otherwise("20241005")
        .alias("DATREF"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_gold_reads_only_what_it_needs(spark, lake, month_csv):
    jobs.daily_chain(spark, lake, month_csv, [DAY4, DAY], VERSION)
    plan = plan_of(jobs.build_silver(read_bronze(spark, lake.bronze, [DAY])))
    assert "Exchange" not in plan
    from emberlake.operators.gold import build_gold

    plan = plan_of(build_gold(jobs.read_silver(spark, lake, [DAY]), ["bioma"]))
    assert "EqualTo(satelite,AQUA_M-T)" in plan
    assert "municipio" not in plan and "lat" not in plan.replace("satelite", "")
    assert plan.count("Exchange") == 1
    assert "extract_day=04" not in plan


def test_yesterday():
    today = dt.datetime.now(dt.timezone.utc).date()
    assert jobs.yesterday() in (today - dt.timedelta(days=1), today - dt.timedelta(days=2))


def test_command_line(spark, lake, month_csv):
    cli.main(["--root", lake.root, "--source", month_csv, "--date", "20241004", "--until", "20241005"])
    assert gold_of(spark, lake, "foco_bioma", [DAY]) == GOLD["foco_bioma"]
    cli.main(["--root", lake.root, "--step", "silver", "--date", "20241005"])
    cli.main(["--root", lake.root, "--step", "foco_estado", "--date", "20241005"])
    assert gold_of(spark, lake, "foco_estado", [DAY]) == GOLD["foco_estado"]
    with pytest.raises(SystemExit):
        cli.parse_args(["--root", lake.root])
    assert cli.dates_of(cli.parse_args(["--root", "r", "--step", "gold"])) == [jobs.yesterday()]
