"""Write PLANS.md: the physical plans of the headline queries, trimmed for reading.

Usage: python scripts/explain_plans.py [sf_dir]   (default /root/testdata/sf0.1)
Plans are the adaptive plans as planned (AQE may still re-plan at run time).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stintwise.operators import careers  # noqa: E402
from stintwise.plans import registry  # noqa: E402
from stintwise.session import local_session, scratch_path  # noqa: E402
from stintwise.sources.bindings import appearances  # noqa: E402
from stintwise.sources.tables import read_fact_table, write_fact_table  # noqa: E402

KEEP = re.compile(r"^\(\d+\) |PushedFilters|PartitionFilters|ReadSchema|Left keys|Right keys|"
                  r"Join condition|Keys \[|Partition By|Arguments")


def trimmed(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"\[file:[^\]]*\]", "[...]", buf.getvalue())
    tree, _, details = text.partition("\n\n\n")
    kept = [line for line in details.splitlines() if KEEP.search(line)]
    return tree.strip() + "\n\n" + "\n".join(kept)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = scratch_path(spark, "plans-fact")
    write_fact_table(appearances(spark, sf), fact)
    cases = [(name, registry.QUERIES[name](spark, sf)) for name in
             ["transfers_with_midseason", "gap_pairs", "breaks", "debuts", "flatten_entries", "graph_edges", "transfers_of_driver"]]
    a = read_fact_table(spark, fact)
    e = careers.yearly_entries(a)
    cases.append(("retirements_announced (from the counted entries)", careers.retirements_announced(a, e)))
    out = ["# Physical plans", "",
           f"Generated by `scripts/explain_plans.py` at `{os.path.basename(sf)}`, local[8].",
           "These are the adaptive plans as planned; AQE may still re-plan at run time.",
           "Scratch paths are elided. Static broadcasting is off, as `cluster_conf` sets it, so",
           "the joins are those of large inputs.", ""]
    for name, df in cases:
        out += [f"## {name}", "", "```", trimmed(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
