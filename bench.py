"""Time the headline queries and print one JSON line.

Each query is built and written to Spark's no-op sink, so that every column of every row
is computed. Settings: BENCH_SF_DIR (tables) and BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalogue.jobs import JOBS  # noqa: E402
from tarn.session import get_spark  # noqa: E402

HEADLINE = (
    "join_group_count",
    "group_count_by_date",
    "letter_counts",
    "basket_parse",
    "stem_documents",
    "pymk_topk",
    "pair_confidence",
    "triple_confidence",
    "fp_rules",
    "kmeans_cost_sq",
    "kmeans_cost_l1",
    "pca_kmeans",
    "item_master",
    "user_profile",
    "tf_cosine_turns",
    "rmse_item_mean",
    "als_rmse",
    "als_recommend",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    JOBS["group_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        JOBS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
