"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed; results are written to the no-op
sink, so every row is produced but none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "search", "search_batch", "eval_hit_at_k", "semantic_search", "topk_cosine", "term_frequency", "doc_frequency",
    "bm25_term", "build_inverted_index", "normalize_ref", "internal_resolve", "in_degree", "top", "parallel_alignment",
    "citation_coverage", "lookup_verse", "verse_fathers", "cross_references", "todays_reading", "date_asof_forward",
    "html_to_text", "page_to_nodes", "extract_elements", "renumber_restarts", "pending_heading_fold",
    "contiguity_check", "unique_id", "substring_of_source", "sink_adjacency", "export_bundle",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from lectern.plans import registry
    from lectern.session import build_session

    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.lectern.spread": cpus, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    plans = registry.queries()
    times: dict[str, float] = {}
    for name in wanted:
        for _ in range(2):
            start = time.perf_counter()
            plans[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
