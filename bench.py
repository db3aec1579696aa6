"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the driver tables; BENCH_CPUS: local cores; BENCH_RUNS: runs per query.
`queries` has the fastest run, `first` the first one, with compilation and whatever is staged for
later runs. Every query writes all its rows to a sink that discards them. The log check and the
scorecard read one staged injection run; whole_injection times such a run with its four tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfproof.operators import inject, triage  # noqa: E402
from shelfproof.plans.queries import QUERIES  # noqa: E402
from shelfproof.session import local_session  # noqa: E402
from shelfproof.sources import adapter, tables  # noqa: E402


def whole_injection(spark, folder):
    """All samples, changes, corrupted tables and the log; the registered queries share one run."""
    names = ("article_master", "promotion_header", "promotion_item", "listing")
    clean = tables.stage(adapter.tables_from(spark, folder, clean=True), names)
    dirty, log = inject.inject(clean, as_of=adapter.AS_OF)
    for name in names:
        dirty[name].write.format("noop").mode("overwrite").save()
    return triage.log_counts(log)


HEADLINE = [
    "c01_referential_integrity", "c02_referential_timing", "c03_listing_conflict",
    "c04_header_item_date_mismatch", "c05_orphaned_cancelled_header", "c06_uom_pack_mismatch",
    "c07_tobacco_on_promotion", "c08_margin_breach", "c09_barcode_invalidity",
    "c10_duplicate_near_duplicate", "c11_completeness", "c12_stale_status",
    "c10_match_counts", "e02_worklist", "v11_gate_summary", "whole_injection",
    "k_log_check", "r_scorecard", "d05_type_counts", "b08_promotion_items", "b11_change_log",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    names = [name for name in HEADLINE if not sys.argv[1:] or name in sys.argv[1:]]
    seconds: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in names:
        for _ in range(1 if name == "whole_injection" else runs):
            start = time.perf_counter()
            run = QUERIES.get(name, whole_injection)
            run(spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            first.setdefault(name, round(took, 3))
            seconds[name] = round(min(took, seconds.get(name, took)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "first": first,
        "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
