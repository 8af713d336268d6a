"""Time the headline queries on one machine, the better of two runs each, and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scriptorium.session import build_session, clear_stored  # noqa: E402
from scriptorium.suite import all_queries  # noqa: E402

HEADLINE = (
    "corpus_stats", "word_count", "normalize_names", "segment_scenes", "html_to_text", "extract_links", "link_catalog",
    "merged_catalogue", "ingest_lists", "outer_merge_orders", "keyed_upsert", "dedupe_first", "priority_dedupe",
    "staged_scripts", "group_set_union", "top_lines", "distinct_words", "jaccard_scores", "jaccard_best_match",
    "jaccard_best_match_docs", "knn_topk", "knn_topk_label", "hash_embed", "scene_topk", "tag_documents",
    "src_csv_roundtrip", "json_map_explode", "document_topk", "jaccard_one_vs_all", "page_existence", "prioritized_merge", "movie_rows",
    "build_prompts", "knn_topk_large", "written_tags",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["word_count"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names if names != ["all"] else queries:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            clear_stored(spark)
        times[name] = round(min(runs), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
