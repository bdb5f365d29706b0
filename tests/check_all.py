"""Run queries against their SQL from the command line: python -m tests.check_all [folder] [key ...]"""

import sys
import tempfile
import time

from tablewright import build_session
from tablewright.plans.catalog import REGISTRY
from tests.oracle import compare, connect


def main(folder: str, keys: list[str]) -> int:
    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for key in keys or REGISTRY:
        item = REGISTRY[key]
        began = time.time()
        try:
            df = item.run(spark, folder)
            if item.oracle:
                problems = compare(df, con, item.oracle)
                size = "" if problems else len(con.execute(item.oracle).fetchall())
            else:
                problems, size = [], f"{df.count()} rows only"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems, size = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {key} {size} {time.time() - began:.1f}s", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
