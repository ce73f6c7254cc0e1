"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caretide.session import build_session  # noqa: E402
from checks.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "hour_weekday_heatmap",
    "clean_visits",
    "clean_feed",
    "enrich_visits",
    "all_features",
    "lag_rolling_whole_table",
    "rolling_features",
    "group_stats_join",
    "quantiles",
    "numeric_report",
    "quality_report",
    "summary_stats",
    "strong_correlations",
    "extract_keywords",
    "clean_post_text",
    "score_sentiment",
    "extract_article",
    "match_queries",
    "corr_spearman_large",
    "corr_kendall_large",
    "anova_oneway",
    "roc_auc",
    "forecast",
    "train_logistic",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "caretide-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM start is not a query
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # noop runs the whole plan without moving rows to the driver.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
