"""Write the final physical plan (after AQE) of every query of the reference's operators to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postlens.plans import registry  # noqa: E402
from postlens.session import local_session  # noqa: E402


def plan_tree(df) -> str:
    """The operator tree of the executed plan, without the per-node detail section."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    tree = text.split("\n\n\n")[0].split("+- == Initial Plan ==")[0]
    return "\n".join(line[:160] for line in tree.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Final plans after adaptive re-planning, `local[*]`, `{sf_dir}`. Generated by `tools/dump_plans.py`.",
        "Queries with a lineage cut (ranks, result-store reads, streams) show the plan after the cut.",
        "",
    ]
    for name, fn in registry.registered().items():
        df = fn(spark, sf_dir)
        df.collect()  # executes this QueryExecution, so the AQE final plan is shown
        out += [f"## {name}", "", "```", plan_tree(df), "```", ""]
    spark.stop()
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
