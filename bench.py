"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the folder of test tables, ``BENCH_CPUS`` the number of cores.
Each query runs once to warm up and then ``BENCH_RUNS`` times; its time is the
median, from building the plan to the last row.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from testbed import queries
from testbed.standins import registry
from wayprint.plans.catalog import ITEM_JOBS
from wayprint.plans.facts import Window
from wayprint.plans.jobs import run_job
from wayprint.plans.profiles import build_state


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def item_jobs_one_by_one(spark: SparkSession, sf: str) -> None:
    """The item jobs as separate queries: what one grouped query replaces."""
    tables = registry(spark, sf)
    for job in ITEM_JOBS:
        run(run_job(tables, job.id))


def day_of_events(spark: SparkSession, sf: str) -> DataFrame:
    """The state of a single day, from all sources."""
    return build_state(registry(spark, sf), Window.day_before(dt.date(2024, 1, 16)))


def headline() -> dict:
    found = {name: query for name, query in queries.PATTERNS.items()}
    found["item_profiles"] = queries.item_profiles
    found["user_profiles"] = queries.user_profiles
    found["day_of_events"] = day_of_events
    daily = queries.all_queries()
    for name in ("c02_daily_rest_usage_counter", "d23_daily_cip_consumption_num", "d24_daily_cip_usage_counter"):
        found[name] = daily[name]
    return found


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in headline().items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(query(spark, sf))
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    start = time.perf_counter()
    item_jobs_one_by_one(spark, sf)
    compared = {"item_jobs_one_by_one": round(time.perf_counter() - start, 3), "item_profiles": seconds["item_profiles"]}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "compared": compared, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
