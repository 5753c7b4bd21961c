"""Times the headline queries; prints one JSON line.

Every query runs to its last row (noop sink). One small query warms the JVM up
first; each query is timed once, plan construction included.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.catalog import catalog  # noqa: E402
from tools.session import local_session  # noqa: E402

HEADLINE = (
    "profile_columns", "profile_lengths", "dup_counts", "pattern_counts",
    "clean_text_docs", "clean_text_pages", "exact_dedup", "exact_dedup_docs", "cap_lengths",
    "noise_filter", "clean_dialogues", "retention_ledger", "pii_report", "pii_flags_docs",
    "redact_reply", "correct_dialogues", "near_dup_drops", "near_dup_kept", "near_dup_groups",
    "coherence_rows", "coherence_summary", "split_assign", "sample_exact", "sample_splits",
    "train_val_split", "coerce_shapes", "render_template", "length_budget", "filters_strict",
    "filters_lenient", "validation_stats", "contamination", "backdoor_report", "history",
    "roundtrip_json", "roundtrip_csv", "minhash_signature", "validated_files", "validate_file",
    "read_json_array", "correction_ledger", "roundtrip_formats", "roundtrip_splits",
    # added in the third round
    "near_dup_verified", "near_dup_index", "split_leaks", "split_groups", "read_json_compact",
    "roundtrip_csv_splits", "retention_ledger_observed", "correct_dialogues_bucketed", "coherence_transfer",
    "coerce_losses",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    queries = catalog()
    wanted = sys.argv[1:] or HEADLINE
    queries["head_rows"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
