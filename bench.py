"""Seconds per headline query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs in full into a sink that keeps nothing, twice; the second run counts, so that
start-up and compilation are not charged to it. Models are trained once, after the others, and are
not in the total. Each time is shown on stderr as its query ends; if the run is ended early, or
after ``$BENCH_SECONDS``, the line holds the queries that are done.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

from riskloom import catalog
from riskloom.session import build_session

HEADLINE = (
    "ratio_features", "numeric_profile", "onehot_mean", "segment_agg", "trailing_windows", "decayed_mean", "trend_slope",
    "two_level_rollup", "latest_snapshot", "last_k", "pivot_count", "spine_join", "freq_encode", "group_relative",
    "target_encode_oof", "fold_assign", "rank_norm", "auc", "blend_search", "corr_filter", "percentile_runs", "knn_target_oof",
    "builder_application", "builder_bureau", "builder_previous", "builder_pos", "builder_card", "builder_installments",
)
TRAINED = ("stack_lr", "null_importance", "sub_model_rollup", "oof_gbt")


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    until = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "1400"))
    timed: dict[str, float] = {}
    trained: dict[str, float] = {}

    def report(*_) -> None:
        line = {
            "metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec", "queries": timed, "training": trained,
            "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
        }
        print(json.dumps(line), flush=True)

    def ended(*_) -> None:
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    queries = catalog.queries()
    for names, out, runs in ((HEADLINE, timed, 2), (TRAINED, trained, 1)):
        for name in names:
            if time.perf_counter() > until:
                break
            for _ in range(runs):
                start = time.perf_counter()
                queries[name](spark, root).write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - start, 3)
            print(name, out[name], file=sys.stderr, flush=True)
    report()


if __name__ == "__main__":
    main()
