"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores. Every
query is run to the end on its full result. The first run of a session also
pays for starting the JVM and compiling, so one untimed query precedes.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from registered_queries import all_queries  # noqa: E402
from shoplens.session import build_session  # noqa: E402

HEADLINE = (
    "source_profile", "curated_interactions", "curated_items", "curated_user_items",
    "item_category_latest", "item_availability_latest", "user_features", "item_features", "user_item_features",
    "quality_report", "feature_retrieval", "popularity_topn", "popularity_ranking", "popularity_metrics",
    "popularity_recommendations", "content_candidates", "user_profiles", "content_metrics",
    "content_recommendations", "active_user_recommendations", "stream_latest_category", "landed_delta_rows",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("popularity_topn")
    timings = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
