"""Compare every query with its oracle: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle

import __spark_entry__ as entry
from formflow.session import build_session


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf)
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                ok, msg, n = oracle.compare(df, con, sqls[name])
            else:
                ok, msg, n = True, "rows only", df.count()
            ok = ok and n > 0
        except Exception as e:
            ok, msg, n = False, "".join(traceback.format_exception_only(e))[:900], -1
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {n:8d} rows {time.time() - t:6.2f}s {'' if ok else msg}", flush=True)
    print(f"{bad} failures")
    sys.exit(bad > 0)


main()
