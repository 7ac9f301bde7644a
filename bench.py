"""Time the headline queries; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardfold.session import build_session  # noqa: E402
from workload import registry  # noqa: E402

HEADLINE = [
    "flagship",
    "clean_display_documents",
    "clean_records_listings",
    "resolve_attempts",
    "card_count_pages",
    "listings_generic_pages",
    "detail_pages",
    "discover_categories",
    "resolve_requests",
    "paginate_visits",
    "paginate_unlimited",
    "enrich_details",
    "dedupe_founders",
    "dedupe_records",
    "run_summary",
    "sample_by_category",
    "read_master",
    "run_pipeline",
    "scrape_categories_records",
]
# Run once untimed: starts the Python workers and the code generator.
WARM_UP = ["card_count_pages", "category_key_customers"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    for name in WARM_UP:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in only:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
