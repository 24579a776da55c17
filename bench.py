"""Times the load jobs and the headline queries; prints one JSON line.

BENCH_SF_DIR names the data directory and BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import time

from threadloom import schemas
from threadloom.plans.registry import QUERIES
from threadloom.plans.workspace import workspace
from threadloom.session import local_session

DIRECTORY = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Jobs that store tables; every query after them starts from these tables.
LOADS = {
    "load_flat": ["flat"],
    "load_relational": list(schemas.RELATIONAL),
    "load_cleaned": [f"{t}_cleaned" for t in schemas.CLEANED_TABLES],
    "load_documents": ["doc_users", "doc_subreddits", "doc_comment_rows", "doc_posts",
                       "doc_moderation"],
}

HEADLINE = [
    "q1_latest_posts", "q2_busy_posts", "q3_top_authors", "q4_gilded_live", "q5_author_like",
    "q6_avg_comments", "chk_orphan_summary", "clean_stats", "ver_comment_removed", "dirty_5_1",
    "dirty_7_1_prefixed", "docq_avg_comments", "docq_posts_moderated_by_comment", "rel_comment",
    "fd_domain", "fd_candidate_keys", "mine_itemsets", "mine_rules", "stream_doc_counts",
]


def main() -> None:
    spark = local_session(CPUS, int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    ws = workspace(spark, DIRECTORY)
    seconds: dict[str, float] = {}
    for name, tables in LOADS.items():
        start = time.perf_counter()
        for table in tables:
            ws.table(table)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        # Every result row is computed; nothing is brought to the driver.
        QUERIES[name](ws).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", DIRECTORY)
    print(json.dumps({
        "metric": "load_and_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
