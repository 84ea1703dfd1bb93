"""Run catalog queries against their SQL: ``python tests/run_catalog.py [root] [name ...]``."""

import sys
import time

sys.path.insert(0, ".")

from compare import connect, mismatch  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    root, names = sys.argv[1], sys.argv[2:]
    # A plain session: the queries must not depend on this library's own settings.
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "16g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, root)
            result = mismatch(df, con, oracles[name]) if name in oracles else f"rows only: {len(df.collect())}"
        except Exception as exc:  # noqa: BLE001
            result = f"{type(exc).__name__}: {str(exc)[:1500]}"
        print(f"{name:26s} {time.time() - start:6.2f}s  {result or 'match'}", flush=True)
