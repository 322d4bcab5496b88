"""Summarise the physical plan of each registered batch query.

    python scripts/explain_plans.py [sf_dir] > PLANS.md

For every query: number of shuffles, join strategies, aggregates, window
and Python operators, and each scan with its pushed filters and read
schema.  Taken from ``explain("formatted")`` before execution (AQE may
still turn a sort-merge join into a broadcast join at run time).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

STREAMING = ("stream_", "completed_orders", "orders_in_progress", "dims_loaded", "dims_files",
             "events_gzip_bulk")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    tree = text.split("\n\n")[0]
    ops = re.findall(r"[+:-]*\s*([A-Za-z]+(?: [A-Za-z]+)*) \(\d+\)", tree)
    joins = sorted({o for o in ops if "Join" in o})
    shuffles = sum(1 for o in ops if o == "Exchange")
    bcast = sum(1 for o in ops if o == "BroadcastExchange")
    aggs = sorted({o for o in ops if "Aggregate" in o})
    other = sorted({o for o in ops if o in ("Window", "Generate", "Expand", "Sort",
                                            "ArrowEvalPython", "BatchEvalPython")})
    scans = []
    for block in re.split(r"\n\(\d+\) ", text):
        if block.startswith("Scan parquet"):
            loc = re.search(r"Location: \w+ \[(.*?)\]", block)
            pf = re.search(r"PushedFilters: \[(.*?)\]\n", block)
            rs = re.search(r"ReadSchema: (.*)", block)
            scans.append((os.path.basename(loc.group(1)) if loc else "?",
                          pf.group(1) if pf else "", rs.group(1) if rs else ""))
    return {"shuffles": shuffles, "broadcasts": bcast, "joins": joins, "aggs": aggs,
            "other": other, "scans": scans}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from orderflow.plans.registry import QUERIES
    from orderflow.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    print("# PLANS\n")
    print(f"Physical plans of the batch queries at `{sf_dir}` (generated by "
          "`scripts/explain_plans.py`; AQE may still change joins at run time).\n")
    print("| Query | Shuffles | Broadcasts | Joins | Aggregates | Other |")
    print("| --- | --- | --- | --- | --- | --- |")
    details = []
    for name, fn in QUERIES.items():
        if name.startswith(STREAMING):
            continue
        s = summarise(plan_text(fn(spark, sf_dir)))
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} "
              f"| {', '.join(s['aggs']) or '-'} | {', '.join(s['other']) or '-'} |")
        details.append((name, s["scans"]))
    print("\n## Scans (pushed filters, read schema)\n")
    for name, scans in details:
        print(f"### {name}\n")
        for table, pf, rs in scans:
            print(f"- `{table}` filters `[{pf}]` reads `{rs}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
