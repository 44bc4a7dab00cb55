"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from siltstone import build_session  # noqa: E402
from siltstone.plans import catalog  # noqa: E402

HEADLINE = [
    "extract_incremental_rental", "extract_incremental_payment", "upsert_payment", "upsert_since_rental",
    "sync_keys_payment", "replace_keys_inventory", "hash_key_film", "link_key_rental", "scd2_dim_staff", "scd2_dim_inventory",
    "scd2_hash_dim_film", "as_of_join_payment_inventory", "fact_payment_star", "fact_rental_star", "calendar_full",
    "sales_by_date_star", "sales_by_film_star", "sales_by_date_corp", "sales_by_film_corp", "hub_inventory",
    "link_rental_inventory", "sat_film_static", "sat_rental_dynamic", "rented_film_vault", "synthetic_rentals",
    "previous_load_time", "dq_unique", "dq_reference",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.python.sql.dataFrameDebugging.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.registered()
    queries["scd2_dim_staff"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({"metric": "warehouse queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": folder.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
