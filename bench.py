"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from litquarry import catalog
from litquarry.session import local_session

HEADLINE = [
    "literature_filter", "disease_rollup", "gene_rollup", "combine_evidence", "labelled_pmids",
    "corpus_build", "cap_per_group", "stratified_sample", "global_rank", "train_val_split",
    "clean_indication", "split_at_headers", "encode_answer", "parse_responses", "build_chat",
    "repair_turns", "repair_tool_calls", "training_set", "ontology_fuzzy_levenshtein",
    "ontology_fuzzy_weighted", "mapped_gene_rows", "count_matrix", "page_extraction", "incremental_ingest",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        catalog.queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(statistics.median(seconds(lambda: run(name)) for _ in range(repeats)), 3)
    print(json.dumps({
        "metric": "headline queries, sum of median seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
