"""Summarise the physical plan of every registered SQL-checked query into PLANS.md.

usage: python tools/plan_report.py [sf_dir]
Counts come from ``explain("formatted")`` of the initial (pre-AQE) plans: AQE may
still turn a shuffle join into a broadcast join at run time.  A query that writes
tables in between (checkpoints, Parquet) is counted with the plans behind them.
The model queries, whose fits are thousands of jobs, are left out.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict[str, int]:
    nodes = re.findall(r"^\(\d+\) ([A-Za-z]+)", plan, flags=re.M)
    c = {n: nodes.count(n) for n in set(nodes)}
    return {
        "scans": c.get("Scan", 0),
        "shuffles": c.get("Exchange", 0),
        "broadcasts": c.get("BroadcastExchange", 0),
        "joins": sum(v for k, v in c.items() if k.endswith("Join")),
        "aggregates": sum(v for k, v in c.items() if k.endswith("Aggregate")),
        "windows": c.get("Window", 0),
        "python": sum(v for k, v in c.items() if "Pandas" in k or "Python" in k),
        "subqueries": len(re.findall(r"^Subquery:\d+", plan, flags=re.M)),
        "pushed_filters": len(re.findall(r"^PushedFilters: \[[^\]]+\]", plan, flags=re.M)),
    }


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@contextlib.contextmanager
def plans_within(found: list[str]):
    """Collect the plans of all frames that are checkpointed or written meanwhile."""
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.readwriter import DataFrameWriter
    checkpoint, parquet, csv = DataFrame.checkpoint, DataFrameWriter.parquet, DataFrameWriter.csv

    def first(f, frame):
        def run(self, *a, **k):
            found.append(formatted(frame(self)))
            return f(self, *a, **k)
        return run

    DataFrame.checkpoint = first(checkpoint, lambda df: df)
    DataFrameWriter.parquet = first(parquet, lambda w: w._df)
    DataFrameWriter.csv = first(csv, lambda w: w._df)
    try:
        yield
    finally:
        DataFrame.checkpoint, DataFrameWriter.parquet, DataFrameWriter.csv = checkpoint, parquet, csv


def main() -> None:
    from panelcraft.plans.registry import QUERIES, oracle_sql
    from panelcraft.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    cols = ["written", "scans", "shuffles", "broadcasts", "joins", "aggregates", "windows", "python",
            "subqueries", "pushed_filters"]
    lines = ["# Plans", "",
             "Generated by `tools/plan_report.py` from `explain(\"formatted\")` of each",
             "SQL-checked query but the model fits (initial plans; AQE may still turn shuffle",
             "joins into broadcast joins at run time). Counts of plan nodes, subqueries and the",
             "plans of the tables that a query writes in between (`written`) included.", "",
             "| key | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    for k in sorted(oracle_sql()):
        if QUERIES[k].__module__ == "panelcraft.plans.models":
            continue
        plans: list[str] = []
        with plans_within(plans):
            df = QUERIES[k](spark, sf)
        total = {"written": len(plans)}
        for plan in [*plans, formatted(df)]:
            for name, n in summarise(plan).items():
                total[name] = total.get(name, 0) + n
        lines.append(f"| {k} | " + " | ".join(str(total[c]) for c in cols) + " |")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(out)


if __name__ == "__main__":
    main()
