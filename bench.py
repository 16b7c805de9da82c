"""Time the headline queries; prints one JSON line."""

import json
import os
import time

from threadline.plans.queries import QUERIES
from threadline.session import build_session, prepare

HEADLINE = (
    "g5_downstream",
    "g7_lineage",
    "g11_path_cache",
    "g12_refresh_path_cache",
    "g14_impact_analysis",
    "g16_pagerank",
    "l1_python_lineage",
    "l2_sql_lineage",
    "r2_vector_top_k",
    "r3_keyword_search",
    "r4_hybrid_search",
    "w1_latest_by_key",
    "t1_scd1_paths",
    "e1_answer_lineage",
    "e2_update_graph",
    "t6_stream_lineage_updates",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cores}]", int(cores) if cores.isdigit() else 8)
    prepare(spark)
    QUERIES["w1_latest_by_key"](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM's and Python's workers
    # the stored graph and cache the traversals read, as in a real deployment
    start = time.time()
    from threadline.plans import stored

    stored.graph_folder(spark, folder)
    stored.cache_folder(spark, folder)
    stored.notebook_cells(spark, folder)
    prepared = time.time() - start
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds,
        "prepare_sec": round(prepared, 3), "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
