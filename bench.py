"""Wall time of the pipeline and of every report; prints one JSON line.

The pipeline steps run once each from the star-schema tables in ``$BENCH_SF_DIR``. The reports run
on the refreshed warehouse tables; each is the median of three runs after one warm-up round.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import document_files, queries  # noqa: E402
from orderlens.plans import REPORTS, ingest_documents, process_lake, run  # noqa: E402
from orderlens.session import tune  # noqa: E402
from orderlens.sinks import read_tables  # noqa: E402

RUNS = 3
# queries timed end to end from the star-schema tables
FROM_SOURCE = ("product_analytics", "hourly_analytics", "department_analytics", "d1_totals", "d10_loyal_departments",
               "dedupe_latest", "describe_numeric", "validate_raw")


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderlens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderlens-bench-"))
        .getOrCreate()
    )


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = tune(session(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    root = spark.conf.get("spark.checkpoint.dir")
    lake, warehouse = f"{root}/lake", f"{root}/warehouse"

    files = document_files(spark, sf_dir, root)
    times = {
        "ingest_documents": timed(lambda: ingest_documents(spark, files, lake)),
        "process_lake": timed(lambda: consume(process_lake(spark, lake, warehouse))),
    }

    tables = read_tables(spark, warehouse)
    jobs = {name: (lambda n=name: consume(run(n, tables))) for name in REPORTS}
    registered = queries()
    jobs |= {f"{name}_from_source": (lambda n=name: consume(registered[n](spark, sf_dir))) for name in FROM_SOURCE}
    for job in jobs.values():
        job()
    times |= {name: statistics.median(timed(job) for _ in range(RUNS)) for name, job in jobs.items()}

    print(
        json.dumps(
            {
                "metric": "total wall time of pipeline and reports",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
