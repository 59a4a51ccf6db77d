"""python tests/run_oracle.py SF_DIR [NAME...]: compare queries with their SQL."""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

import oracle
from pyspark.sql import SparkSession

import __spark_entry__ as entry

if __name__ == "__main__":
    sf, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('CPUS', 8)}]").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql, con = entry.oracle_sql(), oracle.duck(sf)
    for name, f in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = f(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - t
            if name in sql:
                n, diff = oracle.compare(rows, df.columns, con, sql[name])
                print("EQ" if not diff else f"DIFF {str(diff)[:1500]}", name, n, f"{took:.1f}s")
            else:
                print("rows", name, len(rows), f"{took:.1f}s", str(rows[:2])[:300])
        except Exception as e:
            import traceback

            print("ERROR", name, str(e)[:1800], "".join(traceback.format_tb(e.__traceback__)[-2:]))
