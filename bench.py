"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed to completion with the ``noop`` sink (full
computation, no collect to the driver); the reported time per query is the
median of ``$BENCH_REPEATS`` warm runs (default 3) for headline queries and
layers and one run for the others (``$BENCH_OTHER_REPEATS``), with no cached
table between runs.  ``value`` is the sum over the headline queries and the layer
writes; ``queries`` has every query of the invoice model, and the ``write_*``
rows are the layers those queries read: bronze, invoice documents, silver and
the saved match records, each written from the layer below.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bronze_invoice_lineitem",
    "silver_invoice",
    "silver_invoice_lineitem",
    "silver_dq_issues",
    "spend_by_vendor_month",
    "spend_by_category",
    "unit_price_benchmark",
    "payment_calendar",
    "fx_sensitivity",
    "stage_latency",
    "extraction_quality",
    "duplicate_runs",
    "classify_lines_aud",
    "classify_lines_category",
    "processing_notes",
    "ledger_posting_view",
    "result_overlay",
]
LAYERS = {
    "bronze": ("bronze_header", "bronze_lines", "bronze_manifest", "bronze_email"),
    "documents": ("invoice_documents",),
    "silver": ("silver_invoice", "silver_lines"),
    "match_records": ("records_aud", "records_category"),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    others = int(os.environ.get("BENCH_OTHER_REPEATS", "1"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from ledgerlake.plans import model, registry
    from ledgerlake.session import build_session, remove_scratch

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = registry.queries()
    names = [*names, *(n for n in qs if n not in names)] if "BENCH_QUERIES" not in os.environ else names

    def run(name: str) -> float:
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def layers() -> dict[str, float]:
        """Seconds to write each layer from the one below."""
        model.forget_written()
        spent, m = {}, model.Model(spark, sf_dir)
        for layer, tables in LAYERS.items():
            t0 = time.perf_counter()
            for t in tables:
                getattr(m, t)
            spent[f"write_{layer}"] = time.perf_counter() - t0
        return spent

    # the first round compiles code; the layers of the last one are what the queries read
    rounds = [layers() for _ in range(max(repeats, 2))][1:]
    times = {k: round(statistics.median(r[k] for r in rounds), 3) for k in rounds[0]}
    run(names[0])
    for name in names:
        times[name] = round(statistics.median(run(name) for _ in range(repeats if name in HEADLINE else others)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_and_layer_writes_total_median_sec",
        "value": round(sum(t for n, t in times.items() if n in HEADLINE or n.startswith("write_")), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
    }))
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
