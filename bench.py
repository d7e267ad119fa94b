"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run twice through to its last row; the better time counts.
``relayout_roundtrip`` is a whole layout of the point table, not the cached one.
``layout`` repeats the published kind of figure: row groups and bytes a query
must read before and after the layout, from the footers.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "pip_all_wards", "pip_many_areas", "bbox_filter", "bbox_attr_filter", "attr_filter",
    "bbox_refine", "tag_lookup", "hilbert_key", "utm_project", "cut_bbox_complete_ways",
    "cut_polygon_complete_ways", "closure_refs", "ring_completeness", "ring_closure",
    "ring_assembly", "way_geometry", "feature_tables", "multipolygon_regroup", "min_distance",
    "table_digest", "verify_clean", "row_groups_hit", "relayout_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("terrafold-bench")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from terrafold.plans import catalog

    queries = catalog.queries()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken = round(time.perf_counter() - start, 3)
            seconds[name] = min(taken, seconds.get(name, taken))
    layout = [r.asDict() for r in queries["prune_before_after"](spark, sf_dir).collect()]
    print(json.dumps({
        "metric": "headline queries, total of best of two runs",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "layout": layout}))


if __name__ == "__main__":
    main()
