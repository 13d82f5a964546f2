"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a
comma-separated choice of queries (``all`` for every registered one).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siltstone.session import local_session  # noqa: E402
from siltstone.workload import QUERIES  # noqa: E402
from siltstone.workload.scratch import drop_namespaces  # noqa: E402

HEADLINE = (
    "users artists songs song_versions user_levels resolve_events star_resolution "
    "user_facts session_facts song_facts artist_facts "
    "tolerance_join join_title join_composite_key semi_known_users left_join_zero_fill "
    "left_join_lookup membership_flag multi_count_distinct paid_share drop_duplicates "
    "latest_per_key nearest_per_key surrogate_key filter_plays json_scan ingest_raw "
    "partition_overwrite keyed_upsert keyed_upsert_composite promote_table "
    "check_pk_single check_pk_composite"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE

    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})
    # Starts the code generator and the file readers, which no query should be charged for.
    QUERIES["group_count"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        drop_namespaces(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
