"""Headline queries at one scale factor: the median of two runs after one to warm up; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_ONLY``
(comma-separated name parts) and ``BENCH_ALL=1`` for every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.queries import load
from tidemark.session import local_session

HEADLINE = [
    "a01_read_batch", "b01_cursor_range", "b10_window_compact", "b13_limit_keep_ties", "b14_trim_boundary_cohort",
    "b15_keyset_resume", "b19_group_watermarks", "b21_cursor_key", "b23_lookback_dedup", "c02_apply_scd1",
    "c03_apply_scd1_deletes", "c04_apply_scd2", "c05_apply_scd2_deletes", "c07_apply_snapshot_scd2", "c08_snapshot_diff",
    "c13_full_row_dedupe", "d02_bin_contiguous", "d03_bin_weighted", "e02_long", "e06_date", "e09_struct",
    "f03_split_custom_props", "f23_redact_emails", "f24_row_digest", "g01_filter_ops", "h01_fan_out", "h02_tag_ancestor_fks",
    "h06_changed_parents_only", "i02_hl7_segments", "i05_hl7_table_pid", "i10_fhir_observation", "i12_dicom_json",
    "j02_interpolated", "j04_recorded_at", "j08_summary_time_weighted", "j11_frame_samples", "k05_check_pk_unique",
    "k10_table_profile", "n01_report", "n02_active_users", "n03_sessions", "l01_ingest", "h09_hierarchy", "k06_schema_diff", "k07_shape_diff",
    "c03_streaming_scd1", "c05_streaming_scd2", "e10_array", "e11_map", "i14_osdu_records", "i15_sap_records", "d04_bin_units",
    "d06_plan_coverage",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    queries, _ = load()
    names = list(queries) if os.environ.get("BENCH_ALL") else HEADLINE
    if only:
        names = [n for n in queries if any(n.startswith(o) for o in only)]
    spark = local_session(cores, int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            # every column is produced, nothing is sent to the driver
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cores),
    }))


if __name__ == "__main__":
    main()
