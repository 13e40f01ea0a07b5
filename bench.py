"""Times the jobs on the ``events`` table and prints one JSON line.

Silver and gold read the layer below from a lake that is filled once, untimed; the chain fills a new
lake on every run. Each time is the median of the warm runs.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import shutil
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators.gold import build_gold, most_first
from emberlake.operators.silver import build_silver
from emberlake.plans import jobs
from emberlake.schema import BRONZE_COLUMNS, GOLD_TABLES
from emberlake.sources.bronze import read_bronze
from emberlake.sources.lake import Lake
from oracle.events_view import event_dates, raw_hotspots, write_month_files

WARM_RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_time(run) -> float:
    run()
    times = []
    for _ in range(WARM_RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{work}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    try:
        dates = event_dates(spark, sf_dir)
        source = write_month_files(spark, sf_dir, f"{work}/source")
        lake, chained = Lake(f"{work}/lake"), Lake(f"{work}/chained")
        jobs.daily_chain(spark, lake, source, dates, layout="by_date")

        def gold(table: str) -> DataFrame:
            return most_first(build_gold(jobs.read_silver(spark, lake, dates), GOLD_TABLES[table]))

        queries = {
            "silver": lambda: drain(build_silver(read_bronze(spark, lake.bronze, dates))),
            **{t.replace("foco", "gold"): lambda t=t: drain(gold(t)) for t in GOLD_TABLES},
            "bronze_job": lambda: jobs.bronze_job(spark, lake, source, dates, "by_date"),
            "silver_job": lambda: jobs.silver_job(spark, lake, dates, compact=False),
            "gold_job": lambda: jobs.gold_job(spark, lake, dates),
            "daily_chain": lambda: jobs.daily_chain(spark, chained, source, dates, layout="by_date"),
        }
        month = dates[0].replace(day=1)
        sparse = [month - dt.timedelta(days=n) for n in range(1, 31)] + dates[:1]
        one_day = f"{work}/one_day/month={month:%Y%m}"
        single = raw_hotspots(spark, sf_dir).withColumn("data_hora_gmt", F.lit(f"{dates[0]} 01:00:00"))
        single.select(*BRONZE_COLUMNS).write.option("header", True).csv(one_day)
        for date in [*sparse, *dates]:  # months without rows of their own: files with a header only
            path = Path(f"{work}/one_day/month={date:%Y%m}")
            if not path.exists():
                path.mkdir(parents=True)
                (path / "part-0.csv").write_text(",".join(BRONZE_COLUMNS) + "\n")
        other = Lake(f"{work}/other")
        queries |= {
            # All rows on one date of the table's dates, and 30 dates without rows beside one with all.
            "skewed_date": lambda: jobs.daily_chain(spark, other, work + "/one_day/month={month}", dates, layout="by_date"),
            "sparse_dates": lambda: jobs.daily_chain(spark, other, work + "/one_day/month={month}", sparse, layout="by_date"),
        }
        times = {name: median_time(run) for name, run in queries.items()}
    finally:
        spark.stop()
        shutil.rmtree(work, ignore_errors=True)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {"metric": "total_median_seconds", "value": total, "unit": "sec", "queries": times, "sf": scale}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
