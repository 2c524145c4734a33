"""Summarise the physical plan of every registered batch query into PLANS.md.

    python scripts/plan_report.py [sf_dir]

Each query is run once (noop sink) so that the adaptive plan is final, then its
plan is counted: scans, shuffles, broadcast and sort-merge joins, partial group
limits before a shuffle, reused exchanges, pushed filters.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from beatstream.plans.catalog import QUERIES  # noqa: E402
from beatstream.plans.catalog_io import IO_QUERIES  # noqa: E402
from beatstream.session import build_session  # noqa: E402


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    rows = []
    for name in sorted(n for n in QUERIES if n not in IO_QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        p = final_plan(df)
        rows.append((
            name,
            len(re.findall(r"Scan (?:parquet|text|csv)", p)),
            len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", p)),
            len(re.findall(r"BroadcastHashJoin", p)),
            len(re.findall(r"SortMergeJoin", p)),
            len(re.findall(r"WindowGroupLimit .*Partial", p)),
            len(re.findall(r"ReusedExchange", p)),
            "yes" if re.search(r"PushedFilters: \[[^\]]*(GreaterThan|LessThan|EqualTo|In\()", p) else "",
        ))
    out = ["# PLANS", "",
           f"Final (adaptive) physical plans of the batch queries at `{os.path.basename(sf_dir)}`, "
           "generated by `scripts/plan_report.py`.", "",
           "| query | scans | shuffles | broadcast joins | sort-merge joins | partial top-N | reused exchanges "
           "| value filter pushed to scan |",
           "|---|---|---|---|---|---|---|---|"]
    out += [f"| {r[0]} | {r[1]} | {r[2]} | {r[3]} | {r[4]} | {r[5]} | {r[6]} | {r[7]} |" for r in rows]
    out += ["", "Joins here are broadcast at runtime by AQE because the test dimensions are small; "
            "above `spark.sql.autoBroadcastJoinThreshold` they stay sort-merge joins with skew splitting. "
            "Scans of the same table by two branches (for example plays and clicks, both derived from "
            "`events`) count twice.  A query whose result is empty at run time (for example "
            "`repeat_listens` at this scale) shows no scan: AQE replaces an empty stage by an empty "
            "relation.  Counts include scalar subqueries (a global aggregate adds one shuffle).", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
