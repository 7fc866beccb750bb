"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the cores.  Every query is built and run to
the last row (``noop`` sink) after one warm-up query, and counts once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lodgelex.session import local_session  # noqa: E402
from registry.spark_queries import QUERIES  # noqa: E402

HEADLINE = (
    "word_counts_by_country",
    "word_counts_no_stopwords",
    "word_tf_idf",
    "bing_by_country",
    "mostly_used_words",
    "bigrams",
    "bigram_top15",
    "bigram_nodes",
    "total_documents",
    "bigram_tf_idf",
    "polarity_table",
    "sentiment_comparison",
    "high_rated_bigram_top15",
    "high_rated_sentiment",
    "unstemmed_doc_terms",
    "stemmed_doc_terms",
    "processed_descriptions",
    "topic_top_terms",
    "panel_bigrams",
    "panel_sentiment",
    "panel_tf_idf_top10",
    "panel_map",
    "artifact_round_trip",
    "document_ids",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, app="lodgelex-bench")
    run(spark, "country_counts", folder)
    seconds = {name: run(spark, name, folder) for name in names}
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": cores,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
