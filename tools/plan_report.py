"""Write PLANS.md: physical-plan shape of every registered query.

    python tools/plan_report.py [sf_dir]

Each query is executed once; its final adaptive plan is read back with
``explain`` and counted: shuffle exchanges, broadcasts, join strategies,
window operators (and how many run in a single partition), top-k operators,
and scans with pushed filters.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def _count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


def main() -> None:
    from tallyspark.plans.registry import QUERIES
    from tallyspark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16, checkpoint_dir=tempfile.mkdtemp(prefix="plans-shared-"))
    rows = []
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.collect()  # finalises the adaptive plan held by this DataFrame
        text = _plan(df).split("== Initial Plan ==")[0]  # the final adaptive plan only
        rows.append(
            (
                name,
                _count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobinPartitioning", text),
                _count(r"Exchange SinglePartition", text),
                _count(r"BroadcastExchange", text),
                _count(r"BroadcastHashJoin", text),
                _count(r"SortMergeJoin|ShuffledHashJoin", text),
                _count(r"BroadcastNestedLoopJoin", text),
                _count(r"\bWindow \[", text),
                _count(r"TakeOrderedAndProject", text),
                _count(r"PushedFilters: \[[^\]]+\]", text),
                _count(r"PartitionFilters: \[[^\]]+\]", text),
                _count(r"PushedAggregation: \[[^\]]+\]", text),
                _count(r"Scan ExistingRDD", text),
            )
        )
    head = (
        "| query | hash/range shuffles | single-partition exchanges | broadcasts | broadcast hash joins | "
        "shuffle joins | one-row nested-loop joins | windows | top-k | scans with pushed filters | scans of some folders | scans of footers only | checkpoint scans |"
    )
    lines = [
        "# Physical plans",
        "",
        f"Final adaptive plans of every registered query (`tools/plan_report.py`, data `{sf_dir}`, local[8]).",
        "Single-partition exchanges only feed bounded tables: one-row aggregates, offset tables with one row",
        "per sort partition or chunk, top-k merges, calendar months and categories. Grand totals and means are",
        "scalar subqueries, so no plan has a nested-loop join. Checkpoint scans are the ordering operators reading",
        "their reliably checkpointed sort.",
        "",
        head,
        "|" + " --- |" * (head.count("|") - 1),
    ]
    for r in rows:
        lines.append("| " + " | ".join(str(x) for x in r) + " |")
    lines += [
        "",
        "## What changes at 100 TB",
        "",
        "* Dimension joins: at this size AQE broadcasts every dimension. With customers, parts and orders in",
        "  the billions their measured size exceeds the broadcast threshold and the same plans run as shuffle",
        "  joins; only one-row aggregates and bounded offset tables stay broadcast.",
        "* Ordering keys (`a_sequence_and_rank`, `a_master_ledger`, `a_rolling3`, `a_pareto80`, `n_fact_orders`,",
        "  `n_fact_sales`, `n_dim_geography`): the plan is the same at every size, a range-partitioned sort on a",
        "  unique key, a reliable checkpoint, broadcast offset tables, and windows partitioned by chunk.",
        "* The `sales` table and the two CSV inputs are built once per source version and read by every query,",
        "  so per-query work is scans of the needed columns plus the query's own shuffles.",
    ]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
