"""Run every registered query against its SQL: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import normalised, spark_rows, sql_rows  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from billshift.session import tuned  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        tuned(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="check-all-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            got = spark_rows(query(spark, sf_dir))
        except Exception as error:
            print(f"{name:24s} ERROR {str(error)[:1500]}")
            bad += 1
            continue
        seconds = time.perf_counter() - start
        sql = oracle_sql().get(name)
        if sql is None:
            print(f"{name:24s} rows {len(got[1])} {seconds:.2f}s (no SQL)", got[1][:3])
            continue
        want = normalised(*sql_rows(sf_dir, sql))
        same = got == want
        bad += not same
        print(f"{name:24s} {'ok' if same else 'DIFFERS'} {len(got[1])} rows {seconds:.2f}s")
        if not same:
            print("   columns", got[0], want[0])
            mine, theirs = set(got[1]), set(want[1])
            print("   spark only", len(mine - theirs), sorted(mine - theirs)[:3])
            print("   sql only  ", len(theirs - mine), sorted(theirs - mine)[:3])
    return bad


if __name__ == "__main__":
    sys.exit(main())
