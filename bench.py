"""Time the headline queries; prints one JSON line.

The sales table is loaded and joined once (timed as ``load``) and written; the other
queries start from the written tables, as a user of the library would.
BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfcast.catalog import all_queries  # noqa: E402
from shelfcast.settings import build_session, settle  # noqa: E402
from shelfcast.sources.fixture import Retail  # noqa: E402

HEADLINE = [
    "store_summary", "product_summary", "promo_effect_by_sku", "season_month", "season_holiday",
    "price_vs_sku_mean", "price_dev_store_day", "promo_effectiveness", "weighed_quantile_scale",
    "store_rank", "target_encoding", "holiday_distance", "holiday_distance_by_type", "lags",
    "rolling_mean", "rolling_stats", "rolling_sum_count", "price_change", "promo_share_30",
    "recent_promo_7", "trend_slope", "yoy_change", "distinct_promos_30d", "anomalies", "metrics",
    "error_percentiles", "row_errors", "ts_folds", "batch_history", "ensemble_weights",
]


def run(spark, folder: str, queries) -> dict[str, float]:
    spent = {}
    start = time.time()
    retail = Retail(spark, folder)
    retail.loaded = settle(retail.loaded, "loaded")
    spent["load"] = time.time() - start
    retail.sales, retail.returns = settle(retail.sales, "sales"), settle(retail.returns, "returns")
    for name in HEADLINE:
        start = time.time()
        queries[name].build(retail).write.format("noop").mode("overwrite").save()
        spent[name] = time.time() - start
    return spent


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    small = Path(folder).parent / "sf0.001"
    if small.is_dir():
        run(spark, str(small), queries)  # warm the JVM on the smallest tables
    spent = run(spark, folder, queries)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": {name: round(sec, 3) for name, sec in spent.items()},
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
