"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldrec.catalog import CATALOG  # noqa: E402
from goldrec.session import build_session, run_folder  # noqa: E402

HEADLINE = [
    "flt03_compound",
    "flt06_valid_keys",
    "join01_semi",
    "join03_left",
    "join04_lookup",
    "str01_normalize_name",
    "win01_latest",
    "agg01_golden_record",
    "agg13_column_summary",
    "agg14_describe_numbers",
    "agg15_crosstab",
    "agg21_histogram",
    "match03_exact_alternative",
    "match04_fuzzy",
    "pipe01_listed_candidates",
    "pipe02_form_or_approved_candidates",
    "pipe05_consolidation",
    "pipe06_enrichment",
    "pipe07_export",
    "chain_export",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "goldrec-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in HEADLINE:
        with run_folder(spark):
            start = time.perf_counter()
            CATALOG.queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
