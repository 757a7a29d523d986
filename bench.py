"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
The headline is the cost of a batch job: the first run in a fresh session, from
the driver's tables to the finished feature table.  Each query is then fully
executed into Spark's no-op sink (no driver collect), three times: "cold" holds
the first run, "queries" the better of runs 2-3 (steady state).
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "build_features",        # flagship: 43 leakage-free features per game
    "rolling_form",
    "ewma_form",
    "head_to_head",
    "elo_ratings",
    "asof_team_state",       # batch scoring state lookup
    "classification_metrics",
    "roc_points",
    "impute_median",
    "decile_rate",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pregame import catalog
    from pregame.session import local_session
    spark = local_session(cpus=cpus, shuffle_partitions=cpus, app="pregame-bench")
    times, cold = {}, {}
    # the pipeline's input: games derived from orders + lineitem, cleaned, kept
    t0 = time.time()
    n_games = catalog.clean_games(spark, sf_dir).count()
    times["load_games"] = round(time.time() - t0, 3)
    # every query runs three times on the same data: the first run (reported
    # under "cold") pays JVM JIT, code generation and Python worker start-up;
    # the steady state a long-running session sees is the better of runs 2-3
    for key in HEADLINE:
        if key == "asof_team_state":
            t0 = time.time()
            catalog.state_tables(spark, sf_dir)  # written once; the query reads them
            times["write_state"] = round(time.time() - t0, 3)
        runs = []
        for _ in range(3):
            t0 = time.time()
            catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.time() - t0, 3))
        cold[key], times[key] = runs[0], min(runs[1:])
    # three model fits (logistic regression, tree, boosted trees) on the feature table
    t0 = time.time()
    res, _, _ = catalog.trained(spark, sf_dir)
    times["train_models"] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    end_to_end = round(times["load_games"] + cold["build_features"], 3)
    print(json.dumps({"metric": "load_and_build_features_cold_sec", "value": end_to_end, "unit": "sec",
                      "queries": times, "total_sec": round(sum(times.values()), 3),
                      "cold": cold, "cold_total_sec": round(sum(cold.values()), 3),
                      "games": n_games,
                      "cold_us_per_game": round(1e6 * end_to_end / max(n_games, 1), 1),
                      "build_features_us_per_game": round(1e6 * times["build_features"] / max(n_games, 1), 1),
                      "sf": float(m.group(1)) if m else None}))


if __name__ == "__main__":
    main()
