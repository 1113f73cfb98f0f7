"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402
from termpulse.session import make_session  # noqa: E402

HEADLINE = (
    "tokenize_counts", "ngram_terms", "article_top_terms", "day_terms", "term_scores", "elect_daily", "elect_candidates",
    "derivatives", "trending", "event_type_trend", "canonical_urls", "page_text", "outbound_links", "url_dedupe",
    "cursor_cut", "source_cap", "mixed_day_terms", "blurb_prompt",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = make_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    # start the JVM's code paths on the smallest table
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    seconds = {}
    for name in HEADLINE:
        started = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
