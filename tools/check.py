"""Compare registered queries with their DuckDB oracle: python tools/check.py [sf_dir] [names...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pipewright import get_spark  # noqa: E402
from pipewright import registry  # noqa: E402
from pipewright.oracle.compare import compare, duck_connect  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.queries())
    spark = get_spark("local[8]", 8)
    con = duck_connect(sf)
    q, o = registry.queries(), registry.oracle_sql()
    bad = 0
    for n in names:
        t = time.time()
        df = q[n](spark, sf)
        if n not in o:
            print(f"{n:24s} rows-only {df.count()} ({time.time() - t:.1f}s)")
            continue
        r = compare(df, con, o[n])
        bad += not r["ok"]
        print(f"{n:24s} {'OK ' if r['ok'] else 'BAD'} spark={r['spark_rows']} oracle={r['oracle_rows']} "
              f"cols={r['columns_match']} ({time.time() - t:.1f}s)")
        if not r["ok"]:
            if not r["columns_match"]:
                print("   spark :", r["spark_cols"])
                print("   oracle:", r["oracle_cols"])
            else:
                print("   cols  :", r["spark_cols"])
                for x in r.get("only_spark", [])[:3]:
                    print("   S:", x)
                for x in r.get("only_oracle", [])[:3]:
                    print("   O:", x)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
