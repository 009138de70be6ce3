"""Run a query key from the command line.

    python -m hrlens --list
    python -m hrlens turnover_monthly /root/testdata/sf0.01 --show 40
    python -m hrlens pay_topk_large /root/testdata/sf0.1 --csv out/ --parquet out_pq/
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="hrlens")
    ap.add_argument("key", nargs="?", help="query key (see --list)")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01", help="folder of the input tables")
    ap.add_argument("--list", action="store_true", help="list query keys")
    ap.add_argument("--show", type=int, default=20, help="rows to print (0: none)")
    ap.add_argument("--csv", help="write the result as header CSV under this folder (time-stamped)")
    ap.add_argument("--parquet", help="write the result as Parquet to this folder")
    args = ap.parse_args(argv)

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from .plans.catalog import oracle_sql, queries

    if args.list or not args.key:
        checked = oracle_sql()
        for k in queries():
            print(f"{k}{'' if k in checked else '  (unit-tested, no SQL oracle)'}")
        return 0
    qs = queries()
    if args.key not in qs:
        print(f"unknown key {args.key!r}; see --list", file=sys.stderr)
        return 2
    from .session import get_session
    from .sources.sinks import write_csv, write_table
    spark = get_session()
    df = qs[args.key](spark, args.sf_dir)
    if args.show:
        df.show(args.show, truncate=60)
    if args.csv:
        print("csv:", write_csv(df, args.csv, args.key))
    if args.parquet:
        write_table(df, args.parquet)
        print("parquet:", args.parquet)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
