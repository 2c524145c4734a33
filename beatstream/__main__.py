"""Command line: list or run the registered queries.

    python -m beatstream list
    python -m beatstream run mobile_trend --sf /root/testdata/sf0.01 --show 20
    python -m beatstream run build_features --sf /data --shared hdfs:///tmp/ck --out /shared/features
    python -m beatstream explain top_regions_and_users --sf /root/testdata/sf0.01
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="beatstream")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("--sf", required=True, help="folder with the input tables")
        p.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
        p.add_argument("--shared", default=None,
                       help="folder that all executors share (spark.checkpoint.dir); default: the session's")
        if name == "run":
            p.add_argument("--show", type=int, default=20, help="rows to print (0: none)")
            p.add_argument("--out", default=None, help="write the result here instead of printing")
            p.add_argument("--format", default="parquet")
    args = ap.parse_args(argv)

    from beatstream.plans.catalog import QUERIES
    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    if args.query not in QUERIES:
        print(f"unknown query {args.query!r}; see `python -m beatstream list`", file=sys.stderr)
        return 2

    from beatstream.session import build_session
    spark = build_session(args.master, extra={"spark.checkpoint.dir": args.shared} if args.shared else None)
    df = QUERIES[args.query](spark, args.sf)
    if args.cmd == "explain":
        df.explain(mode="formatted")
    elif args.out:
        df.write.mode("overwrite").format(args.format).save(args.out)
    elif args.show:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
