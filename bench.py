"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
cores. A query is planned, run to the end and its rows thrown away. A first, untimed query
starts the JVM's code paths. ``pipeline`` writes all tables from raw records.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.queries import AS_OF, RUN_TS, Shop, queries  # noqa: E402
from shoplake.plans import pipeline  # noqa: E402
from shoplake.sources.session import create_spark, scratch_dir  # noqa: E402
from shoplake.sources.tables import SILVER, read_layer  # noqa: E402

HEADLINE = (
    "silver_products silver_users silver_cart_summary silver_cart_items stage_counts "
    "user_cart_agg favourite_category customer_360 product_demand product_performance "
    "stock_risk category_distribution top10_products_sold cart_summary_report "
    "revenue_by_category top10_spenders basket_by_age_band stock_risk_report "
    "panel_revenue panel_top10"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = create_spark(
        "shoplake-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    run("customer_360")
    times = {name: run(name) for name in HEADLINE}
    started = time.perf_counter()
    root = scratch_dir(spark)
    pipeline.write_silver(Shop(spark, sf_dir).raw, root, AS_OF, RUN_TS)
    pipeline.write_gold(read_layer(spark, root, SILVER), root, RUN_TS)
    times["pipeline"] = round(time.perf_counter() - started, 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
