"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from chainmark.plans.all_queries import QUERIES
from chainmark.session import local_session

HEADLINE = [
    "t5_status", "a1_rp_stats", "j3_interval_join", "a7_tg_stats", "j7_rp_tg_left", "j2_segment_lookup", "p8_line_id",
    "f3_mainline_filter", "g3_edges", "g7_interpolate", "g8_substring", "g11_segments", "g6_snap", "g6_snap_crowded", "j5_nearest_switch",
    "g14_clip_points", "n2_n3_n4_n7_devices", "n11_j12_path_counts", "w3_sequence_ids", "b3_b4_merged_positions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "chainmark-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed run of the first query, so that its time is not that of starting and compiling.
    QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
