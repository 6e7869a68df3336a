"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tradewind.registry import catalogue  # noqa: E402
from tradewind.session import build_session  # noqa: E402

HEADLINE = (
    "stg04_orders_history", "stg05_order_items", "stg07_clickstream", "stg08_inventory_updates",
    "mdl01_order_lines", "mdl02_orders_with_customers", "mdl03_streaming_orders_enriched",
    "mdl04_clickstream_sessionized", "mdl05_inventory_enriched", "mdl06_orders", "mdl07_customers",
    "mdl08_products", "mdl09_revenue_daily", "mdl10_funnel", "mdl11_customer_segments_snapshot",
    "mdl12_recent_orders_feed", "join11_known_customer_share", "dq17_inventory_updates_suite",
    "snk11_discover_new_files", "str02_parse_topic",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        # every row is computed and discarded: no result is collected, no column pruned
        queries[name].plain(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("stg01_customers")  # start-up, not measured
    seconds = {name: round(min(run(name) for _ in range(2)), 3) for name in HEADLINE}
    scale = re.search(r"sf([\d.]+)$", folder.rstrip("/"))
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else folder,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
