"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

Each query runs twice into the ``noop`` sink; the second, warm run counts.
"""

from __future__ import annotations

import json
import os
import time

from reelpress.plans.catalog import CATALOG
from reelpress.session import build_session

HEADLINE = [
    "mean_age_by_occupation",
    "top_rated_items",
    "top_genres_by_segment",
    "similar_item_pairs",
    "prepared_articles",
    "unique_articles",
    "articles_not_delivered_before",
    "urls_not_tracked",
    "sketch_membership",
    "sentiment_by_keyword",
    "page_article_records",
    "parsed_page_digests",
    "page_links",
    "aggregates_after_upsert",
    "nearest_upstream_success",
    "corpus_report",
    "items_similar_to_title",
    "urls_unseen_by_table_and_sketch",
    "flow_articles",
    "flow_aggregates",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
        master=f"local[{cpus}]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            CATALOG[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm run, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
