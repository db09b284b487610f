"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query is built
and run to the end three times, every column of every row computed (the ``noop`` sink), and the
median counts. One untimed run of the flagship query starts the session's code paths.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sampleledger.catalog import queries  # noqa: E402
from sampleledger.session import local_session  # noqa: E402

HEADLINE = (
    "a01_well_ambiguity",
    "a06_tool_flags",
    "a07_completion",
    "a08_good_files",
    "a08_problem_files",
    "a10_compare_counts",
    "a11_discrepancies",
    "a13_patches",
    "j01_resolve_strict",
    "j08_all_seqpreps",
    "j09_visit_flags",
    "j11_resolved_samples",
    "j12_resolved_by_name_well",
    "j14_three_way_status",
    "l03_records_by_keys",
    "m01_raw_inputs",
    "m07_stage_plan",
    "m11_matching_files",
    "m12_regrouped",
    "p02_store_names",
    "r02_move_old_names",
    "r06_rename_by_mapping",
    "r07_insert_database",
    "r10_sync_plan",
    "s04_store_listing",
    "s12_stale_snapshots",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    known = queries()

    def run(key: str) -> float:
        start = time.perf_counter()
        known[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("a07_completion")
    times = {key: median(run(key) for _ in range(3)) for key in HEADLINE}
    spark.stop()
    name = sf_dir.rsplit("/", 1)[-1]
    sf = float(name[2:]) if name.startswith("sf") else name
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
