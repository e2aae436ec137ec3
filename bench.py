"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfspan.operators import demand, evaluate, models, price  # noqa: E402
from shelfspan.operators.joins import join_calendar, join_prices  # noqa: E402
from shelfspan.operators.panel import melt  # noqa: E402
from shelfspan.plans import features, retail, training  # noqa: E402
from shelfspan.queries.joins import wide_months  # noqa: E402
from shelfspan.session import build_session, settle  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            # A narrow panel grows into 132 columns, so small partitions are kept apart.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    stored = {}

    def keep(name, df):
        stored[name] = settle(df, name)

    def chain():
        consume(features.forecasting_features(retail.sales(spark, folder), stored["calendar"], stored["prices"]))

    steps = {
        "warm_up": lambda: retail.table(spark, folder, "lineitem").groupBy("l_returnflag").count().collect(),
        "panel_build": lambda: keep("panel", retail.panel(spark, folder)),
        "calendar_and_prices": lambda: (keep("calendar", retail.calendar(spark, folder)), keep("prices", retail.prices(spark, folder))),
        "wide_table": lambda: keep("wide", wide_months(spark, folder)),
        "melt": lambda: consume(melt(stored["wide"])),
        "calendar_price_join_fill": lambda: keep(
            "priced",
            price.fill_prices(join_prices(
                join_calendar(stored["panel"].drop("date"), stored["calendar"].select("d", "date", "wm_yr_wk")), stored["prices"])),
        ),
        "lags_activity": lambda: consume(demand.add_activity(demand.add_lags(stored["panel"]))),
        "rolling_ewm": lambda: consume(demand.add_ewm(demand.add_spread(demand.add_rolling(stored["panel"])))),
        "demand_patterns": lambda: consume(demand.add_intermittency(demand.add_days_since_sale(stored["panel"]))),
        "feature_chain_132": lambda: consume(features.forecasting_features_from(stored["priced"], stored["calendar"])),
        "feature_chain_from_source": chain,
        "feature_store": lambda: consume(
            features.store_features(stored["priced"].join(stored["calendar"].drop("date", "wm_yr_wk", "month", "year", "wday"), "d"))
        ),
        "forecast_metrics": lambda: evaluate.evaluate(retail.forecast(spark, folder)).collect(),
        "training_frame": lambda: keep("training", training.training_frame(stored["panel"])),
        "train_score_evaluate": lambda: training.compare(
            stored["training"], {"boosted": models.boosted_trees(5, 4), "forest": models.random_forest(5, 4)}
        )[2].collect(),
    }
    seconds = {}
    for name, run in steps.items():
        began = time.time()
        run()
        seconds[name] = round(time.time() - began, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    seconds.pop("warm_up")
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else None, "panel_rows": stored["panel"].count(),
    }))


if __name__ == "__main__":
    main()
