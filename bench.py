"""Times of the warehouse load and of the five reports; prints one JSON line.

Each time is the median of warm runs. A load writes its table; a report is read to the last row.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from starmart.driver.marts import new_namespace, source_file, stand_ins
from starmart.mapping import RAW
from starmart.plans.warehouse import REPORTS, load_dimensions, load_fact, load_staging
from starmart.session import build_session

RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "starmart-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, list[float]] = {}

    def timed(name: str, job):
        start = time.perf_counter()
        result = job()
        seconds.setdefault(name, []).append(time.perf_counter() - start)
        return result

    for file in RAW:
        folder = source_file(spark, sf_dir, file)
    tables = stand_ins(spark, sf_dir)
    for _ in range(RUNS + 1):
        staging, datamart = new_namespace(spark, "staging"), new_namespace(spark, "datamart")
        timed("load_staging", lambda: load_staging(spark, folder, staging))
        dims = timed("load_dimensions", lambda: load_dimensions(spark, tables, datamart))
        fact = timed("load_fact", lambda: load_fact(tables, dims, datamart))
        for name, report in REPORTS.items():
            timed(name, lambda: report(fact, dims).write.format("noop").mode("overwrite").save())
    medians = {name: round(statistics.median(runs[1:]), 3) for name, runs in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "warehouse load and five reports, median of warm runs",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
