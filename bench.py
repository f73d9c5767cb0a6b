"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is executed in full with the no-op sink (every row computed,
nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "d3_asof_nearest", "d3_asof_labels_tolerance", "c2_align_spans", "b7_tokenize_sentence",
    "d9_match_sets", "d10_overlaps", "e4_score_entities", "e7_prf_report", "e9_doc_examples",
    "e15_roc_auc", "f14_distance_bin_errors", "g1_group_split", "g9_sort", "h10_propagate",
    "h5_attention", "h13_rnn_scan", "c14_negative_spans", "c15_sample_per_group", "c17_negative_pairs",
    "c18_candidate_pairs", "e14_classification_report", "e27_eval_row",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera.plans import fixtures as FX
    from tessera.plans import registry
    from tessera.session import build_session

    spark = build_session(f"local[{cpus}]", app="tessera-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    registry.load()
    times = {}
    t0 = time.time()
    for f in (FX.sentences, FX.gold_docs, FX.pred_docs):     # derived corpora, written once
        f(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times["derive_corpus"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_clock", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
