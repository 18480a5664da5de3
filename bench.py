"""Seconds per headline query, as one JSON line.

The fact is first assembled and written as the partitioned table that the other
queries read, as a daily run would do; ``ingest`` is the time for that. The forest
comes last but for the ensemble, which needs it. Each query's seconds go to the
error stream as it ends, and the JSON line to the output.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stocktide.operators import forest
from stocktide.operators.calendar import calendar_of
from stocktide.operators.ensemble import align
from stocktide.operators.prep import feature_columns, feature_matrix, rank_correlations, target_correlations
from stocktide.operators.seasonal_arima import forecast_with_fallback
from stocktide.operators.simple_ar import simple_ar
from stocktide.plans import reports
from stocktide.plans.features import feature_table, sided_features
from stocktide.plans.forecasting import ensemble_run
from stocktide.session import build_session, materialize, new_path
from stocktide.sources.demand import demand_levels, raw_demand
from stocktide.sources.tables import read_by_month, write_by_month
from stocktide.registry.base import AS_OF, MIN_YEAR

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = os.environ.get("BENCH_CPUS", "8")


def consume(df) -> None:
    """Compute every row and column, and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", cores=CORES, memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        result = run()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        return result

    def ingest():
        path = new_path(spark, "raw_demand")
        write_by_month(raw_demand(spark, FOLDER), path)
        return read_by_month(spark, path)

    timed("warm_up", lambda: consume(raw_demand(spark, FOLDER)))
    demand = timed("ingest", ingest)
    timed("j1_weekly_demand", lambda: consume(reports.weekly_demand(demand, AS_OF, MIN_YEAR)))
    timed("j2_year_over_year", lambda: consume(reports.year_over_year(demand, AS_OF)))
    timed("j3_stockout_risk", lambda: consume(reports.stockout_risk(demand, AS_OF)))
    timed("j4_inventory_positioning", lambda: consume(reports.inventory_positioning(demand, AS_OF)))
    timed("j5_promo_lift", lambda: consume(reports.promo_lift(demand, MIN_YEAR)))

    levels = demand_levels(spark, FOLDER)
    features = timed(
        "i5_feature_table",
        lambda: sided_features(feature_table(demand, calendar_of(demand), levels)),
    )
    columns = feature_columns(features)
    timed("f6_top_correlations", lambda: consume(rank_correlations(target_correlations(features, columns), 15)))
    matrix = timed("i7_feature_matrix", lambda: materialize(feature_matrix(features, columns), "matrix"))

    timed("i22_simple_ar", lambda: consume(simple_ar(demand)))
    first = timed("i24_forecasts", lambda: materialize(forecast_with_fallback(demand), "arima"))
    def train():
        model = forest.fit_forest(matrix.where("side = 'train'"))
        return materialize(forest.predict(model, matrix.where("side = 'test'")), "predicted")

    second = timed(f"i8_forest_{forest.FOREST.trees}_trees", train)
    points = materialize(align(first, second), "points")
    timed("i31_ensemble", lambda: [consume(df) for df in ensemble_run(points).values()])

    del times["warm_up"]
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
