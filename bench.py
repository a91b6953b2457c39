"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The ``prep_*`` entries are the one-time stages (listings joins, split and row
features; learned parameters; encodings; processed table written partitioned
by split; baseline fit); every other entry is one registered query, executed
fully with the ``noop`` sink (no collect to the driver), then the forest fit,
the boosting fit (``t02_fit_s``, outside the total) and the scoring of raw
requests by the forest.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "m08_all_metrics", "m10_mispricing_cost", "m12_segment_mae", "m14_interval",
    "e01_target_encoding_fit", "e05_label_encoder_fit", "e06_label_encoder_apply", "e07_unknown_key_share",
    "l06_time_split", "l07_leakage_audit", "f23_rare_grouping",
    "q04_null_counts", "q14_describe", "q16_verdict", "q18_record_validation",
    "a01_distribution_profile", "a06_target_correlation", "a08_high_pairs", "a10_histogram", "a12_box_summary", "a14_anova",
    "r02_residual_summary", "r05_segment_stats", "r07_category_errors", "r10_worst_predictions",
    "t09_overfit_gap", "c02_weighted_vote", "g02_threshold_gate", "s11_golden_set",
    "d01_mean_shift", "d02_kl_divergence", "d04_weekly_drift", "d05_retrain_decision", "m13_health_tier",
    "p01_batch_scoring", "p05_serving_counters", "j08_listings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    from resale.operators import scoring
    from resale.plans import catalog
    from resale.plans import prepared as P
    from resale.plans import q_models as models
    from resale.plans.q_streaming import requests
    from resale.session import get_session

    spark = get_session(f"local[{cpus}]", int(cpus) * 2)
    qs = catalog.queries()
    times: dict[str, float] = {}

    def timed(name, run):
        started = time.perf_counter()
        out = run()
        times[name] = round(time.perf_counter() - started, 3)
        return out

    stages = [
        ("prep_base", P.base), ("prep_params", P.learned_params), ("prep_encodings", P.encoding_fit), ("prep_processed", P.processed),
        ("prep_baseline", P.baseline_fit), ("prep_rmse", P.model_rmse),
    ]
    for name, stage in stages:
        timed(name, lambda stage=stage: stage(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda name=name: qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    rates = {"feature_rows_per_s": round(P.processed(spark, sf_dir).count() / max(times["prep_base"] + times["prep_processed"], 1e-9))}
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    rates["t01_train_rows"] = models.train_frame(spark, small).count()
    timed("t01_fit_sf0.001", lambda: models.fitted_forest(spark, small))
    rates["t02_fit_s"] = round(models.timed_boost(spark, small)[1], 3)  # all 300 rounds on the fit rows of train
    model = scoring.ModelPackage(
        P.learned_params(spark, small), P.encoding_fit(spark, small), models.feature_plan(spark, small), models.fitted_forest(spark, small), P.model_rmse(spark, small), "bench",
    )
    asked = requests(spark, sf_dir)
    timed("p01_forest_scoring", lambda: model.score(asked).write.format("noop").mode("overwrite").save())
    rates["scoring_rows_per_s"] = round(asked.count() / max(times["p01_forest_scoring"], 1e-9))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf, **rates}))


if __name__ == "__main__":
    main()
