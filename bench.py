"""Benchmark: full warehouse build plus every view and measure query.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Stages: bronze landing (adapter + write), silver build, gold dimensions,
gold fact (with its key check), then each view and measure query forced
with a ``noop`` write (full computation, nothing collected to the driver).
A small untimed run at sf0.001 warms the JVM first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans import views  # noqa: E402
from tillroll.plans.measures import measures  # noqa: E402
from tillroll.plans.pipeline import default_root, run_pipeline  # noqa: E402
from tillroll.session import get_session  # noqa: E402
from tillroll.sources.adapter import FIXTURE_RULES, bronze_tables  # noqa: E402


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _build(spark, sf_dir: str, root: str):
    # The fixture plants rows without a location, which are set aside.
    return run_pipeline(spark, bronze_tables(spark, sf_dir), root=root, rules=FIXTURE_RULES,
                        date_range="data", on_unmatched="quarantine", register_views=False)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(match.group(1)) if match else None
    spark = get_session(
        f"local[{cpus}]", app_name="tillroll-bench", shuffle_partitions=int(cpus) * 2,
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # Runs go to <spark.checkpoint.dir>/tillroll (a private folder only when unset).
    root = default_root(spark)

    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        warm = _build(spark, warm_dir, root)
        for make in _work(warm.gold).values():
            _force(make())

    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    wh = _build(spark, sf_dir, root)
    build_total = time.perf_counter() - t0
    groups = ["bronze", "silver", "gold_dims", "gold_fact"]
    for label in groups:
        timings[label] = round(wh.stage_seconds.get(label, 0.0), 3)

    for name, make in _work(wh.gold).items():
        start = time.perf_counter()
        _force(make())
        timings[name] = round(time.perf_counter() - start, 3)

    total = build_total + sum(v for k, v in timings.items() if k not in groups)
    print(json.dumps({
        "metric": "warehouse_build_and_queries",
        "value": round(total, 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        # Comparable with the published load figure (rows landed per second).
        "orders_load_rows_per_sec": round(
            next(s.rows for s in wh.steps if s.step == "bronze.orders") / max(timings["bronze"], 1e-9)),
        "rows": {s.step: s.rows for s in wh.steps},
    }))
    spark.stop()


def _work(gold) -> dict:
    return {
        "v1_sales_summary": lambda: views.sales_summary(gold),
        "v2_product_performance": lambda: views.product_performance(gold),
        "v3_customer_analysis": lambda: views.customer_analysis(gold),
        "v4_regional_performance": lambda: views.regional_performance(gold),
        "v5_shipping_performance": lambda: views.shipping_performance(gold),
        "v6_monthly_trends": lambda: views.monthly_trends(gold),
        "measures_overall": lambda: measures(gold),
        "measures_by_segment_year": lambda: measures(gold, by=["segment", "year"]),
        "measures_by_ship_month": lambda: measures(gold, by=["year", "month"], date_role="ship"),
    }


if __name__ == "__main__":
    main()
