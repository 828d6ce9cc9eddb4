"""Summarise the executed physical plan of every registered query into PLANS.md.

    python scripts/plan_report.py [sf_dir]

For each query: shuffles (Exchange), reused shuffles, scans with their pushed
filters and read schema, and any broadcast / cartesian / Python evaluation, taken
from the final adaptive plan after one run.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventflow.functions.messages import envelopes_from_raw, parse_envelopes  # noqa: E402
from eventflow.operators import insights as ins  # noqa: E402
from eventflow.operators.windows import events_per_window  # noqa: E402
from eventflow.plans.catalog import QUERIES  # noqa: E402
from eventflow.session import build_spark, scratch_path  # noqa: E402
from eventflow.sinks.files import write_csv  # noqa: E402
from eventflow.sources.files import read_events_csv  # noqa: E402
from eventflow.sources.fixtures import read_fixture_events  # noqa: E402

FLAGS = ("BroadcastExchange", "BroadcastHashJoin", "CartesianProduct", "BroadcastNestedLoopJoin",
         "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "Window", "Generate")


def final_only(plan: str) -> str:
    """Drop every ``== Initial Plan ==`` block of an adaptive plan (nested too)."""
    kept, skip_at = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :|"))
        if skip_at is not None:
            if indent > skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = indent
            continue
        kept.append(line)
    return "\n".join(kept)


def summarise(plan: str) -> list[str]:
    plan = final_only(plan)
    lines = []
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)[^\n]*", plan)
    reused = plan.count("ReusedExchange")
    lines.append(f"shuffles: {len(exchanges)} ({', '.join(sorted(set(exchanges))) or 'none'}); reused: {reused}")
    seen = set()
    for m in re.finditer(r"FileScan (\w+) \[[^\]]*\][^\n]*?PushedFilters: \[([^\]]*)\][^\n]*?ReadSchema: (struct<[^>]*>)", plan):
        key = m.group(0)
        if key in seen:
            continue
        seen.add(key)
        lines.append(f"scan {m.group(1)}: pushed [{m.group(2)}] read {m.group(3)}")
    flags = [f for f in FLAGS if re.search(rf"\b{f}\b", plan)]
    lines.append("other: " + (", ".join(flags) if flags else "none"))
    return lines


def before_the_write(spark, sf_dir: str) -> dict:
    """The DataFrames that the batch job, the producer and the streams write out."""
    path = scratch_path(spark, "plans-csv")
    write_csv(read_fixture_events(spark, sf_dir), path)
    raw = read_events_csv(spark, path)
    envelopes = envelopes_from_raw(read_fixture_events(spark, sf_dir))
    return {
        "before the write: batch job, items and types": lambda: ins.item_event_counts(raw),
        "before the write: batch job, daily visitors": lambda: ins.daily_visitors(raw),
        "before the write: producer, envelopes from CSV": lambda: envelopes_from_raw(raw),
        "before the write: stream, parsed messages": lambda: parse_envelopes(envelopes),
        "before the write: stream, window metric": lambda: events_per_window(parse_envelopes(envelopes)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_spark("plans", master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Executed plans", "",
           f"Generated by `scripts/plan_report.py` on `{sf_dir}` (final adaptive plans after one run; "
           "streaming and round-trip queries show the plan of the read-back step; what they write is at the end).", ""]
    frames = {name: (lambda q=q: q(spark, sf_dir)) for name, q in QUERIES.items()}
    for name, frame in {**frames, **before_the_write(spark, sf_dir)}.items():
        df = frame()
        df.collect()  # run this DataFrame's own plan, so the adaptive plan is final
        plan = df._jdf.queryExecution().executedPlan().toString()
        out.append(f"## {name}")
        out.append("")
        out.extend(f"- {ln}" for ln in summarise(plan))
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
