"""Times headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) say over what and on how many cores.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent}:{os.environ.get('PYTHONPATH', '')}"

HEADLINES = [
    "delta_stats", "forward_delta", "gripper_binarize", "gripper_rel2abs", "noop_audit", "episode_stats", "vector_stats", "merged_stats",
    "histogram_quantiles", "dataset_offsets", "data_packing", "nearest_resample_earlier", "linear_resample", "relabel_actions_drop_last",
    "gripper_delta", "rot_rpy_to_matrix", "fk_serial_chain", "butterworth_smooth", "nest_steps", "unpack_range", "pending_downloads", "best_candidate",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from framewright import queries

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    took = {}
    for warm in (True, False):
        for name in HEADLINES:
            began = time.perf_counter()
            queries.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf).name}))


if __name__ == "__main__":
    main()
