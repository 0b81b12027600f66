"""Print the physical operators of every registered query (scans, exchanges,
joins, subqueries, codegen stages) to check shuffles and pruning.

usage: python tools/explain_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from lograft.plans.queries import QUERIES  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Scan|Subquery|CollectMetrics|Union|Window|HashAggregate|Sort |Generate|"
                  r"ArrowEvalPython|MapInPandas|BatchEvalPython)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lograft-explain-"))
    for name in names:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = [ln for ln in plan.split("\n") if KEEP.search(ln)]
        n_exchange = sum("Exchange" in ln for ln in lines)
        print(f"### {name}  (exchanges: {n_exchange})")
        for ln in lines:
            ln = re.sub(r"#\d+L?", "", ln)
            ln = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/", "Location: ", ln)
            print("    " + ln[:230])
        print()
    spark.stop()


if __name__ == "__main__":
    main()
