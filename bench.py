"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default all),
BENCH_QUERIES a comma-separated choice of registered queries (`all` for every one). Each
query is built and fully executed, every row and column, into the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seqloom.plans import QUERIES  # noqa: E402
from seqloom.session import local_session  # noqa: E402
from seqloom.staging import scope  # noqa: E402

HEADLINE = [
    "join_expand_hierarchy",
    "where",
    "sum",
    "average",
    "first",
    "last_on",
    "join_strings",
    "join_strings_large_groups",
    "count_distinct_next_lane",
    "location_pick",
    "order_by",
    "with_pos",
    "with_pos_any_order",
    "with_pos_large_groups",
    "insert_at",
    "reverse",
    "balanced_split",
    "except_bag",
    "upsert_first_wins",
    "upsert_last_wins",
    "keep_last_by_key",
    "join_bridge_ids",
    "lookup_by_id_kind",
    "filter_nested_by_membership",
    "pending_by_group",
    "parse_size_gb",
    "src_split_string",
    "src_run_xml",
    "src_html_rows",
    "src_html_table",
    "sink_json_documents",
    "sink_tsv",
    "assign_read_by_group_size",
    "repair_lane",
    "repair_read_type",
    "work_manifest",
    "stream_upsert_first_wins",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the engine
    seconds = {}
    for name in names:
        with scope(spark):
            started = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
