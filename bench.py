"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

# What is timed. Searches read an index that is written once per session; building
# it is timed by itself (first line).
HEADLINE = {
    "index_documents": None,
    "B1_standard_tokens": "B1_standard_tokens",
    "B7_postings_and_statistics": "B7_postings_and_statistics",
    "D1_term_search": "D1_term_search",
    "D3_fuzzy_terms": "D3_fuzzy_terms",
    "F1_entity_search": "F1_entity_search",
    "F1_search_table": "F1_search_table",
    "F1_linked_entity_search": "F1_linked_entity_search",
    "D9_geo_polygon": "D9_geo_polygon",
    "F2_blocking": "F2_blocking",
    "C3_upsert_entities": "C3_upsert_entities",
    "C12_rebuild_entity_set_catalog": "C12_rebuild_entity_set_catalog",
    "D14_same_element": "D14_same_element",
    "F6_entity_set_search": "F6_entity_set_search",
    "J6_filters_above_join": "J6_filters_above_join",
}


def timed(run) -> float:
    begin = time.perf_counter()
    run()
    return time.perf_counter() - begin


def main() -> None:
    with contextlib.redirect_stdout(sys.stderr):
        from quarry.session import local_session
        from quarry.workload import model
        from quarry.workload.catalog import QUERIES

        spark = local_session(CPUS, "bench")
        spark.sparkContext.setLogLevel("ERROR")
        spark.range(1000).selectExpr("sum(id)").collect()

        def drain(key: str) -> None:
            QUERIES[key](spark, SF_DIR).write.format("noop").mode("overwrite").save()

        seconds = {}
        for name, key in HEADLINE.items():
            if key is None:
                seconds[name] = timed(lambda: model.document_index(spark, SF_DIR))
            else:
                # Best of the runs: the first one also builds indexes and compiles.
                seconds[name] = min(timed(lambda: drain(key)) for _ in range(RUNS))
            print(name, round(seconds[name], 2), file=sys.stderr, flush=True)
    result = {
        "metric": "total_headline_query_time",
        "value": round(sum(seconds.values()), 2),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": SF_DIR.rstrip("/").split("sf")[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
