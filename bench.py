"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
computes all its rows and columns (written to Spark's ``noop`` sink).
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from inkfold.plans.queries import REGISTRY, TIMED

HEADLINE = [
    "config_sweep", "wer_documents", "edit_stats_documents", "ocr_error_summary", "field_wer_means", "match_rates",
    "caption_records", "entity_record", "json_repair_parse", "word_frequency", "top_words", "similar_words",
    "local_contrast", "otsu_threshold", "su_binarize", "su_binarize_images", "binarization_metrics", "drdm", "dice_multiclass",
    "crop_boxes", "exact_split", "batching",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's code paths and the Python workers on one small query.
    REGISTRY["field_wer_means"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    taken = {}
    for name in HEADLINE:
        began = time.perf_counter()
        (REGISTRY | TIMED)[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {taken[name]} s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total seconds", "value": round(sum(taken.values()), 3), "unit": "sec",
        "queries": taken, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
