"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from checks.queries import QUERIES, documents  # noqa: E402
from pithy.operators.summarize import add_summaries  # noqa: E402
from pithy.session import local_session  # noqa: E402

HEADLINE = (
    "normalize_text", "split_sentences", "validation_profile", "dedup_first", "hash_split",
    "lead_n", "textrank_summary", "tfidf_weights", "sentence_strength", "pagerank_scores",
    "rouge1", "rouge2", "rouge_l", "method_summary", "method_summary_stemmed",
    "score_distribution", "length_histogram", "quality_by_source", "page_articles", "page_digest",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    count = int(cpus) if cpus.isdigit() else 8
    # The test tables are one row group each.
    spark = local_session(cpus, shuffle_partitions=count, partitions=2 * count)
    QUERIES["normalize_text"](spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    # Per article, the summary step alone: sentences and summary, measured row by row inside one run over all documents.
    timed = add_summaries(documents(spark, sf), timed=True)
    steps = timed.agg(F.avg("seconds_lead_3").alias("lead_3"), F.avg("seconds_textrank").alias("textrank")).first().asDict()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
        "seconds_per_article": steps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
