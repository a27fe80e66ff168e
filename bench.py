"""Benchmark the headline queries.

Runs every headline query of the registry on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {key: median_sec}, ...}

Each query is run once to warm up and three times timed; the action is a
``noop`` write, so the whole plan executes without pulling rows to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "seller_features_latest", "daily_demand_sums", "hierarchy_rollup", "brand_size_status_cube", "group_describe",
    "calendar_spine_fill", "leak_free_rolling", "demand_classes", "category_quantile_trim", "two_stage_group_trim",
    "kruskal_wallis_h", "roc_points", "top_cities_by_value", "upsert_merged_image", "normalized_documents",
    "exact_duplicate_documents", "gazetteer_tagging", "near_duplicate_documents", "html_listings",
    "page_title_text", "url_query_params", "entity_mapping_cosine", "basket_simulation",
]


def shuffle_bytes_by_group(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, read from Spark's event log."""
    stage_group, written = {}, defaultdict(int)
    files = sorted(os.path.join(root, n) for root, _, names in os.walk(log_dir) for n in names
                   if n.startswith("events_") or n.startswith("local-") or n.startswith("app-"))
    for path in files:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    group = stage_group.get(ev.get("Stage ID"))
                    if group:
                        written[group] += int(m.get("Shuffle Bytes Written", 0))
    return dict(written)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    from mercato.plans.registry import load_all
    from mercato.session import get_spark

    log_dir = tempfile.mkdtemp(prefix="mercato-bench-events-")
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app_name="mercato-bench",
                      extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                             "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"})
    reg = load_all()
    timings, rows = {}, {}
    for k in keys:
        q = reg[k]
        df = q.build(spark, sf_dir)
        spark.sparkContext.setJobGroup(f"warmup:{k}", k)
        rows[k] = df.count()  # warm-up (also compiles and caches file listings)
        runs = []
        spark.sparkContext.setJobGroup(k, k)
        for _ in range(3):
            t0 = time.perf_counter()
            q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[k] = round(statistics.median(runs), 3)

    spark.sparkContext.setJobGroup("extras", "extras")
    # Extras: HTML parse throughput and streaming rows/s.
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    mb = pages.selectExpr("sum(octet_length(html))").first()[0] / 1e6
    t0 = time.perf_counter()
    reg["html_listings"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    html_s = time.perf_counter() - t0
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    t0 = time.perf_counter()
    reg["stream_hourly_windows"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    stream_s = time.perf_counter() - t0

    out = {
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": rows,
        "html_mb": round(mb, 3),
        "html_mb_per_sec": round(mb / html_s, 3),
        "stream_rows_per_sec": round(n_events / stream_s, 1),
        "cores": int(cpus),
        "spark": spark.version,
    }
    spark.stop()
    try:
        by_group = shuffle_bytes_by_group(log_dir)
        out["shuffle_bytes"] = {k: by_group.get(k, 0) // 3 for k in timings}
    except Exception:  # noqa: BLE001 - metrics are best effort
        pass
    print(json.dumps(out))


if __name__ == "__main__":
    main()
