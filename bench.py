"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores. The input
relations are written first; that time is reported apart. A query is timed by a write that
computes every row and column and keeps none; ``value`` is the sum over the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from checks.relations import SPARK_SQL, Relations  # noqa: E402
from mapledger.session import local_session  # noqa: E402

HEADLINE = (
    "ext_from_url", "classify_resources", "resolve_resources", "read_plan", "pick_default", "pick_bundle",
    "files_by_suffix", "latest_version", "previous_versions", "layer_current_version", "layer_latest_file",
    "group_path", "schema_drift", "refresh_scan", "plan_updates_dry", "refresh_report", "refresh_summary",
    "build_catalog", "full_catalog", "search_titles", "search_documents", "top_datasets", "dataset_contents",
    "bbox_overlap", "bbox_overlap_stored", "intersects_box", "bbox_join", "bbox_join_exact", "capped_sql",
    "infer_schema", "layer_extent", "load_layer_where", "load_table", "free_query_join", "free_query_spatial",
    "absolutize_pages", "layer_bundle", "reconcile_field_case", "remap_field_refs", "style_audit",
    "read_catalog_tables", "read_versions", "read_geojson_features", "read_field_dictionary", "bundle_manifest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="mapledger-bench")
    spark.sparkContext.setLogLevel("ERROR")
    start = time.time()
    relations = Relations(spark, sf_dir)
    for name in SPARK_SQL:
        relations(name)
    prepared = time.time() - start
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
        "prepare_relations": round(prepared, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
