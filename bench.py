"""Headline queries at one scale; prints one JSON line.

Each query runs once to warm up and is then timed into a sink that takes every column of
every row. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from padron.session import builder

# Transform, checks, load with uniqueness, references, search, statistics, maintenance.
HEADLINE = (
    "transform",
    "source_check",
    "validar_paciente_completo",
    "response_conformance",
    "referential_integrity",
    "unique_violations",
    "load_errors",
    "migration_stats",
    "migrate_all",
    "batch_summary",
    "migrate_and_resume",
    "identifiers_available",
    "search",
    "list_page_deep",
    "estadisticas",
    "migration_status",
    "create_rows",
    "update_rows",
    "delete_rows",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = run(name)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
