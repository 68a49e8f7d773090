"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from leadrank.plans.catalog import QUERIES

HEADLINE = ["q_lead_ranking", "q_lead_scores", "q_entity_resolution", "q_unique_match", "q_evidence_union", "q_holds",
            "q_latest_per_entity", "q_code_class", "q_typed_citations", "q_semi_cascade", "q_checks",
            "q_nested_records", "q_draft_verdict", "q_history_upsert", "q_rank_eval"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("leadrank-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["q_run_params"](spark, folder).collect()  # start the session
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    sf = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else folder}))


if __name__ == "__main__":
    main()
