"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from siltline import build_session
from siltline.plans.registry import QUERIES

# The seven trip analyses, the star queries, and the heavier entity, layout and stream operators.
HEADLINE = (
    "trips_by_day_of_week",
    "payment_type_revenue",
    "passenger_distribution",
    "monthly_fee_impact",
    "fee_share",
    "top_locations",
    "key_set_lookup",
    "star_daily_revenue",
    "star_zone_revenue",
    "star_payment_mix",
    "star_fact_build",
    "dense_surrogate_key",
    "user_company_join",
    "current_state_long",
    "current_state_wide",
    "history_forward_fill",
    "history_chunked_fill",
    "notified_full_rows",
    "last_n_per_entity",
    "run_stats",
    "compact_files",
    "convert_format",
    "dim_upsert",
    "patch_explode",
    "stream_current_state",
)


def run(spark, sf_dir: str, name: str) -> float:
    """Seconds to run a query to the end, without moving its rows to the driver."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    extra = {"spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="siltline-bench-")
    spark = build_session("bench", f"local[{cpus}]", cpus, extra)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    for name in names:  # warm-up: class loading, code generation, file listing
        run(spark, sf_dir, name)
    for name in names:
        times[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(repeats)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries (median of runs after each ran once)",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
