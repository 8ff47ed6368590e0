"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder with the test tables  (default /root/testdata/sf0.1)
BENCH_CPUS     local threads                (default: all)
BENCH_QUERIES  comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from texelframe.session import build_session
from workload.queries import QUERIES

HEADLINE = (
    "s5_explode_raw", "s6_write_read_pixels", "s9_catalog_summary",
    "p8_to_srgb_unclamped", "p12_to_rgbm", "p16_copy_channel_from", "p21_to_slope_space", "p22_quantize_unorm",
    "n2_to_normal_map_clamp", "n3_color_to_normal",
    "m2_mip_plan", "m3_next_mip_box", "m4_next_mip_max", "m5_next_mip_mitchell", "m6_next_mip_kaiser", "m7_resize_box",
    "m8_pyramid_box", "m9_pyramid_alpha", "m10_pyramid_normal", "m11_pyramid_slope", "m12_pyramid_from_source",
    "a2_range_scale", "a9_diff_report", "a9_compare_by_name", "a10_histogram", "a12_tile_stats", "a13_block_quantize_error",
    "a14_size_estimate", "j1_pair", "j4_stitch_missing", "r5_stitch_extent", "r7_stitch_errors", "r7_stitch_clean",
    "b1_assign_batches", "x1_convert_rgbm",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # a first query, so that none of the timed ones pays for the start
    QUERIES["s5_explode_raw"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
