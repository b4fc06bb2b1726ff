"""Run registered queries against their SQL: python tests/run_catalog.py [sf_dir] [name ...]"""

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from callweave.catalog import ORACLE, QUERIES
from callweave.operators.skew import HOT_ROWS_SETTING
from callweave.session import builder
from compare import connect, difference, spark_rows, sql_rows


def main(root, names):
    spark = builder("catalog").master("local[8]").config("spark.sql.shuffle.partitions", "8") \
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("HOT_ROWS"):  # try the path for large keys on small data
        spark.conf.set(HOT_ROWS_SETTING, os.environ["HOT_ROWS"])
    con = connect(root)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            got = spark_rows(QUERIES[name](spark, root))
            took = time.time() - start
            diff = difference(got, sql_rows(con, ORACLE[name])) if name in ORACLE else None
        except Exception as e:  # report and go on
            took, diff, got = time.time() - start, f"{type(e).__name__}: {str(e)[:1500]}", ([], [])
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name} {len(got[1])} rows {took:.2f}s {diff or ''}",
              flush=True)
    print(f"{bad} failed")


main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
