"""Compare all or some queries with DuckDB: ``python tests/check.py <data folder> [key ...]``."""

import os
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from bankops.session import build_session  # noqa: E402
from oracle import compare, connect  # noqa: E402


def main(folder, keys):
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("HOT_ROWS"):  # send every key above this many rows through the split form
        spark.conf.set("spark.bankops.hotRows", os.environ["HOT_ROWS"])
    con, sqls = connect(folder), entry.oracle_sql()
    bad = 0
    for key, fn in entry.queries().items():
        if keys and not any(key == k or (k.endswith("*") and key.startswith(k[:-1])) for k in keys):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if key in sqls:
                diff = compare(df, con, sqls[key])
            else:
                diff = None if df.count() else "no rows"
        except Exception as e:
            diff = "".join(traceback.format_exception_only(e))[:700]
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {key} {'S' if key in sqls else 'R'} {time.time() - start:.2f}s {diff or ''}", flush=True)
    print("differences:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
