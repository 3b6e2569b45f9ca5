"""Write PLANS.md: the physical plan facts of the headline operators.

Each registered query is run as it is registered, over the driver tables, and
its formatted plan is reduced to what matters at scale: scans and their read
schema, pushed filters, exchanges (shuffles), join strategies, aggregates and
codegen stages. Every query that starts from the trips has the trips' own two
scans and join in its plan.

Usage: python scripts/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> dict:
    tree = text.split("\n\n")[0]
    if "== Final Plan ==" in tree:  # executed adaptive plan: keep only the final one
        tree = tree.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    kinds = []
    for node_id in re.findall(r"(?<!Broadcast)Exchange \((\d+)\)", tree):
        m = re.search(rf"\({node_id}\) \w*Exchange\b(?:[^\n]*\n)*?Arguments: "
                      r"(?:hashpartitioning\((?P<h>\w+)|rangepartitioning\((?P<r>\w+)|"
                      r"(?P<s>SinglePartition))", text)
        if m:
            kinds.append(f"hash({m['h']})" if m["h"] else f"range({m['r']})" if m["r"]
                         else "single")
    return {
        "scans": len(re.findall(r"Scan parquet", tree)),
        "read_schema": sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*)", text))),
        "pushed": sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", text))),
        "exchange_kinds": kinds,
        "broadcasts": len(re.findall(r"BroadcastExchange \(", tree)),
        "joins": re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                            r"BroadcastNestedLoopJoin|CartesianProduct)[^\n(]*", tree),
        "aggregates": len(re.findall(r"HashAggregate", tree)),
        "codegen": len(set(re.findall(r"codegen id : (\d+)", text))),
        "generate": "Generate" in tree,
        "union": "Union" in tree,
    }


def main() -> None:
    from pyspark.sql import SparkSession

    from strata.plans.registry import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    keys = ("scan_raw", "silver_trips", "quarantine_trips", "layer_counts", "check_raw_report", "check_silver",
            "checkpoint_report", "rule_catalog", "mart_daily", "mart_monthly", "mart_quality", "daily_study",
            "zone_join_broadcast", "zone_join_merge", "profile_nulls", "quarantine_reasons",
            "quarantine_sample", "check_mart_reconciles", "check_not_null", "check_unique_grain",
            "scan_partitioned", "scan_partitioned_month")
    lines = [
        "# Physical plans of the headline operators",
        "",
        f"Generated by `scripts/plan_report.py` from the registered queries over `{sf_dir}`,",
        "`local[8]`, AQE on, after each query ran (AQE's final plan). A *scan* is one",
        "Parquet scan; shuffles are listed by partitioning. The trips themselves are",
        "two scans (`lineitem`, `orders`) and one join.",
        "",
        "| Query | Scans | Shuffles / broadcasts | Joins | Hash aggregates | Codegen stages |",
        "|---|---:|---|---|---:|---:|",
    ]
    details = []
    for name in keys:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # run this DataFrame itself: explain then shows AQE's final plan
        text = formatted(df)
        info = summarize(text)
        kinds = ", ".join(info["exchange_kinds"]) or "none"
        if info["broadcasts"]:
            kinds += f" + {info['broadcasts']} broadcast"
        lines.append(
            f"| {name} | {info['scans']} | {kinds} | {', '.join(info['joins']) or 'none'} | "
            f"{info['aggregates']} | {info['codegen']} |")
        details.append(f"### {name}\n")
        details.append("* ReadSchema: " + "; ".join(f"`{r}`" for r in info["read_schema"]))
        details.append("* PushedFilters: " + ("; ".join(f"`{p}`" for p in info["pushed"]) or "none"))
        if info["generate"]:
            details.append("* rows produced by a generator (no union of scans)")
        if info["union"]:
            details.append("* narrow union (inputs or metadata rows), no join")
        details.append("")
    lines += ["", "## Scan details", ""] + details
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"wrote {out}")
    spark.stop()


if __name__ == "__main__":
    main()
