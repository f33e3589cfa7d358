"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR``: folder of the tables; ``BENCH_CPUS``: local cores. Each query is computed
completely (every column of every row) and thrown away. A new JVM runs uncompiled code for the
first searches, so three run first, untimed.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from samples import lake
from samples import queries as Q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
NAMES = (
    "link_fixpoint",
    "link_hits_by_pass",
    "link_two_pass",
    "link_fixpoint_everybody",
    "search_coverage",
    "subject_report",
    "erase_mask_replace",
    "erase_delete",
    "erase_except_all",
    "erase_anti_join",
    "update_by_row_match",
    "swap_check",
    "erase_partition_rewrite",
    "mask_columns_by_table",
    "candidate_keys",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def people(count: int) -> Callable[[SparkSession, str], DataFrame]:
    """The search for the first so many customers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = lake.tables(spark, sf_dir)
        asked = lake.every_customer(spark, sf_dir).orderBy("subject").limit(count)
        return Q.search(
            tables,
            asked,
            Q.NO_COUNTRY,
            columns=lake.columns(spark, tables),
            partition_columns=lake.PARTITIONS,
        ).hits

    return run


def seconds(spark: SparkSession, query: Callable[[SparkSession, str], DataFrame]) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    chosen: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: Q.QUERIES[n] for n in NAMES}
    chosen["link_fixpoint_100_people"] = people(100)
    chosen["link_fixpoint_1000_people"] = people(1000)
    with contextlib.redirect_stdout(sys.stderr):
        spark = session()
        for query in (Q.QUERIES["link_fixpoint"], people(100), Q.QUERIES["link_fixpoint"]):
            seconds(spark, query)
        times = {name: seconds(spark, query) for name, query in chosen.items()}
        spark.stop()
    sf = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    line = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
