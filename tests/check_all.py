"""Compare every registered query with its SQL twin: python tests/check_all.py [sf_dir] [names...]"""

import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

import __spark_entry__ as entry
from compare import connect, differences
from remitlens.session import build_session

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    wanted = sys.argv[2:]
    failed = []
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                diff = differences(df, con, sqls[name])
            else:
                n = df.count()
                diff = []
                print(f"rows-only {name}: {n}")
        except Exception as e:  # report and go on with the next query
            diff = [f"{type(e).__name__}: {str(e)[:600]}"]
        print(f"{'ok  ' if not diff else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        for d in diff:
            print("     ", d[:700])
        if diff:
            failed.append(name)
    print("failed:", failed)
